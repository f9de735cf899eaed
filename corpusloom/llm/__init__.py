"""Operators of a training-data pipeline: filters, scores, search, tokens, packing."""
