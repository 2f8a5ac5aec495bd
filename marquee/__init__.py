"""Multi-source catalogue building and serving on Spark DataFrames."""
