"""Spark-native batch analytics: release reconciliation, scoring and text pipelines."""
