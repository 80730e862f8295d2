"""Operators of a training-data pipeline (URL reputation, near duplicates, mixing, packing, ...)."""
