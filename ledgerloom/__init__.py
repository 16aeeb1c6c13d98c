"""Multi-tenant accounting analytics on Spark DataFrames."""
