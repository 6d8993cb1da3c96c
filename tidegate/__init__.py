"""Deliver partitioned hub messages into tables with Spark.

Operators take and return DataFrames, so one definition serves a batch replay
and a running stream alike.
"""
