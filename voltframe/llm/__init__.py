"""Operators for building training data from a text corpus."""
