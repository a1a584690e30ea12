"""Whole pipelines, and the checked query roster over the given tables."""
