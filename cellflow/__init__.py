"""Cell tables and models on Spark DataFrames."""
