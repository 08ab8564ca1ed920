"""Spark-first privacy engine for tabular and text data."""

__version__ = "0.1.0"
