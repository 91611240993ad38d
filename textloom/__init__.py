"""Text-collection indexing, ranking and evaluation on Spark DataFrames."""
