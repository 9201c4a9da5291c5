"""Rental-marketplace and order analytics as PySpark DataFrame functions.

Sub-packages:

``sources``    CSV, gzip CSV, JSON, Parquet, dated-directory and JDBC readers
``sinks``      CSV, JSON and partitioned Parquet writers
``functions``  column expressions: cleaning, time stamps, validity checks
``operators``  DataFrame -> DataFrame: popularity, scores, orders, windows, ...
``streaming``  the minute cadence as Structured Streaming queries
``plans``      end-to-end jobs and their command line
"""

from lodgeflow.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
