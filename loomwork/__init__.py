"""Batch analytics on Spark DataFrames: near-duplicate documents, ratings and
collaborative filtering, web-graph measures, and order-book time series.

Every operator is a function from DataFrames to a DataFrame.
"""
