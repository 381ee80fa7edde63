"""Operators for preparing training data, their queries and the corpus pipeline's building blocks."""
