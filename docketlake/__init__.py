"""Spark-native pipeline for daily regulator digests.

DataFrame in, DataFrame out: every operator is a function over DataFrames or
Columns, and nothing here keeps state between calls.
"""
