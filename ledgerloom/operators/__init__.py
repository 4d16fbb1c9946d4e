"""Table-to-table jobs: every function takes DataFrames and returns a lazy DataFrame."""
