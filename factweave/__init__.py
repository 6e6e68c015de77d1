"""Governed-assertion analytics on Spark DataFrames."""
