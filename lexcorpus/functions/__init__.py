"""Column rules: text, dates, URLs, identifiers, languages and quality checks."""
