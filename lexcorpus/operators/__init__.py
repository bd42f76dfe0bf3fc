"""Table jobs: each takes DataFrames and returns a DataFrame."""
