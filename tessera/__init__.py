"""Spark-first analytics for bibliographic review corpora."""
