"""Spark-native listing and event analytics."""
