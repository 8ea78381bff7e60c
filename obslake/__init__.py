"""obslake: vintaged, provenance-carrying observation analytics on Spark DataFrames."""
