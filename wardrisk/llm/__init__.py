"""Operators for large text corpora: counting, cleaning, near-copies, packing, encoding and search."""
