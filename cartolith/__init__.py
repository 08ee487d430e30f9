"""Cartolith: a Spark-native engine for tagged features, map layers and tiles."""
