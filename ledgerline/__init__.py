"""ledgerline: a Spark-native engine for building, maintaining and reporting on a
corpus of company regulatory filings held as tables.

Every operator is a lazy function from DataFrames to a DataFrame. Nothing is
collected to the driver; ordering, batching and incremental work are expressed
as joins, aggregations, range partitioning and windows over bounded groups.
"""

__version__ = "0.1.0"
