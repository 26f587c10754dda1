"""Layered business-listing analytics on PySpark DataFrames."""
