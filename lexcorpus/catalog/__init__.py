"""The registered queries: every job on the given tables, and the same result in plain SQL."""
