"""Operators: functions from DataFrames to a DataFrame. They run no Spark action."""
