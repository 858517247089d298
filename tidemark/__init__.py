"""Spark-first incremental records engine."""
