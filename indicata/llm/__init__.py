"""Operators of a training-data pipeline, each re-expressed as Spark jobs.

Nothing outside this subpackage imports it; ``queries`` holds the registered
queries and their SQL.
"""
