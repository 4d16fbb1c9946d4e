"""Settlement accounting jobs on Spark DataFrames."""
