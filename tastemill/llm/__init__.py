"""Operators for large training-text tables: cleaning, copies, tokens and packing."""
