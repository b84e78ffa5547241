"""Reusable DataFrame operators built from Spark's own."""
