"""Operators for text, web and vector corpora. Nothing else in the library imports them."""
