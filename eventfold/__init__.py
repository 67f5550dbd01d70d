"""Spark-native engine for event listings."""
