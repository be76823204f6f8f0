"""Spark-native analytics over semi-structured posting records."""
