"""Set-based jobs: every function takes DataFrames and returns DataFrames, without writing anything."""
