"""Search, ranking, text-classification and evaluation operators for Spark DataFrames."""
