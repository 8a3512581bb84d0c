"""Spark-native knowledge-graph analytics."""
