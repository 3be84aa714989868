"""Operators for training-data corpora: cleaning, de-duplication, search, mixing, packing."""
