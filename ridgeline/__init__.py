"""Ridgeline: Spark-native analytics over collections of one-dimensional curves."""
