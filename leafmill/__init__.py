"""Leafmill: a Spark-native engine that turns wiki sites into a clean, queryable corpus."""

__version__ = "0.1.0"
