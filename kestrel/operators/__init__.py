"""Operators: every function takes and returns DataFrames (or fitted spark.ml models)."""
