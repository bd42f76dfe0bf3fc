"""Spark-native building blocks for legal and policy document corpora."""

__version__ = "0.1.0"
