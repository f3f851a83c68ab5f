"""Operators that prepare corpora for training, on Spark DataFrames."""
