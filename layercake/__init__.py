"""Layered (bronze / silver / gold) tables on Spark DataFrames."""
