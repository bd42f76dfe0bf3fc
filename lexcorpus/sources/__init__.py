"""Readers for records, queries, cached tables and text files."""
