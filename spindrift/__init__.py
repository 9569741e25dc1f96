"""Analytics operators and jobs that take and return Spark DataFrames."""
