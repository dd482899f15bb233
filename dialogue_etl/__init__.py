"""Dialogue corpus jobs as PySpark DataFrames."""
