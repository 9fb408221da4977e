"""Spark-native environmental sensor analytics and training-data operators."""
