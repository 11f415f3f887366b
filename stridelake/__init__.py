"""Spark-native operators for keyed, time-ordered tables.

Every operator is a plain function from DataFrames to a DataFrame; plans stay
lazy and columnar, and keys are always parameters.
"""
