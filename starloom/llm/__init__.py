"""Operators for preparing training data: filters, search, dedup, scoring, mixing, tokens."""
