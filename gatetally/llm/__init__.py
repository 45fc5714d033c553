"""Operators of a large training-data pipeline; nothing outside imports them."""
