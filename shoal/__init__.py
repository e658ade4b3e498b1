"""Recommendation and behaviour analytics written with PySpark DataFrames."""
