"""Operators that prepare text for training: encoding, quality, duplicates, personal data, packing."""
