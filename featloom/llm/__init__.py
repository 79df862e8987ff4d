"""Operators for preparing training text and web pages. Nothing else here imports them."""
