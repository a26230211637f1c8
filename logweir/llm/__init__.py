"""Operators of a training-data pipeline: tokens, duplicates, language, packing, search."""
