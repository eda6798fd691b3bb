"""Spark-first case-document and corpus analytics."""
