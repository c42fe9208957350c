"""Spark-native pre-annotation and annotation-data analytics."""
