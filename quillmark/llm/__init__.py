"""Operators for preparing training data: dedup, filters, extraction, tokens, packing."""
