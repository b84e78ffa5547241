"""Marketplace analytics as Spark jobs: raw files -> star schema -> reports -> exploration."""
