"""Spark-native analytics for ground-survey and aerial-imaging accuracy work."""
