"""Operators for preparing training text, and the corpus pipeline made of them."""
