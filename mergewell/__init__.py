"""Record consolidation and text-corpus preparation on Spark DataFrames."""
