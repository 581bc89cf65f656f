"""Customer analytics for retail data on Spark.

Every operator is a function from DataFrames to a DataFrame; see README.md for
the module map.
"""
