"""Spark-native analytics over code-hosting activity events."""
