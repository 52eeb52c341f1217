"""Point-in-time equity analytics on Spark DataFrames."""
