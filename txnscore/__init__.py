"""txnscore: transaction-fraud feature, training and scoring operators on Spark.

Every operator is a small function over DataFrames (or a Spark ML stage) that
Catalyst can plan: no RDDs, no row-at-a-time Python UDFs.
"""

__version__ = "0.1.0"
