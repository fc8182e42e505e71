"""Spark-native curation engine."""
