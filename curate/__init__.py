"""Curating large article collections with Spark DataFrames."""
