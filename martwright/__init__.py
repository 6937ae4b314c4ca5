"""Batch analytics for regional sales data on Spark DataFrames.

Layers, lowest first: ``functions`` (Column builders), ``sources`` and ``sinks``
(CSV, Parquet and catalog tables), ``operators`` (DataFrame steps) and ``plans``
(whole jobs: landing, cleansing, marts, full refresh).
"""
