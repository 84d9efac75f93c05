"""Operators for training-data pipelines: cleaning, near-duplicates, search, mixing and tokens over whole tables."""
