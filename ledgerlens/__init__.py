"""ledgerlens: user-risk features and a decision-tree classifier over event logs, on Spark.

Every operator is a function from DataFrames to a DataFrame built from
built-in Spark expressions, aggregates and windows (see README.md).
"""

__version__ = "0.1.0"
