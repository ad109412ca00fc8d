"""Kinfold: schema-free record clustering on Spark DataFrames."""
