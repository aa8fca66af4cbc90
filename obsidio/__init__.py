"""Spark-native analytics over multi-source observation data."""

__version__ = "0.1.0"
