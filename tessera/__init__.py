"""Spark-first analytics engine."""
