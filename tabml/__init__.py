"""Supervised learning on large tables, expressed as Spark jobs."""
