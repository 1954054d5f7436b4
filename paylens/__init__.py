"""paylens: transaction analytics and data quality on Spark.

Every operator takes DataFrames and returns DataFrames; nothing here starts a
session or collects rows, apart from one-row summaries that drive a decision.
"""
