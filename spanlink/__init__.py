"""Spark-native text span extraction, linking and scoring."""
