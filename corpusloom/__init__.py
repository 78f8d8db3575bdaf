"""Corpus analytics on PySpark: admission gates, deduplication, claims, retrieval, fact checks, metrics and event rules."""
