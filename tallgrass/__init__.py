"""Document-to-structure analytics on Spark DataFrames."""
