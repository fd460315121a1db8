"""Spark-native catalog ingestion and analytics engine."""
