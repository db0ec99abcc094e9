"""Spark-native price-index analytics engine."""
