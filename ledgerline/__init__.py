"""ledgerline: business-analytics operators for loyalty, delivery and weekly-mart data on Spark.

Every operator is a function from DataFrames (plus column names and parameters) to a DataFrame,
written with built-in Catalyst expressions so that it scales with the cluster.
"""

__version__ = "0.1.0"
