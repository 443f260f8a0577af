"""A Spark-native engine for structure-aware, verified-lossless, queryable archives."""

__version__ = "0.1.0"
