"""Operators for large training corpora: filters, near-duplicates, mixing and token output."""
