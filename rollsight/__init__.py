"""Spark-native analytics for scored sensor streams of a five-stand rolling line."""
