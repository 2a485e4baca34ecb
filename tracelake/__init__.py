"""Trace lake: typed trace and telemetry messages as Spark DataFrames.

The public entry points are functions from DataFrame to DataFrame, grouped by
what they do:

* ``tracelake.sources``   bring messages in (batches, wire bytes, raw records)
* ``tracelake.operators`` filter, route, fold, validate and sample the log
* ``tracelake.functions`` column expressions over typed values
* ``tracelake.streaming`` the same work as Structured Streaming jobs
* ``tracelake.plans``     physical care: checked joins, ordered counting
"""
