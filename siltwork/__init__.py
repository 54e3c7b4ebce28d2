"""Batch and streaming data-pipeline operators written for PySpark.

Every transform takes DataFrames and returns a DataFrame.  Column names and
dates are parameters, nothing reads the wall clock, and the core uses built-in
Spark expressions only, so Catalyst sees whole plans.
"""

from siltwork.session import build_session

__all__ = ["build_session"]
