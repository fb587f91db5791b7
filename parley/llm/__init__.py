"""Operators for the preparation of training text, and the corpus pipeline's queries."""
