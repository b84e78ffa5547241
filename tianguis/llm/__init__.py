"""Operators for preparing training data for language models. Nothing outside this package imports it."""
