"""Operators for preparing training data: mixing, packing, counting, filtering and searching."""
