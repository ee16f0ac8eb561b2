"""Product clustering and assignment review on Spark DataFrames."""
