"""Operators for preparing training data: mixing, de-duplication, search, extraction, packing."""
