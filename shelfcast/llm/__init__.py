"""Operators for training data: deduplication, filters, packing, fingerprints and encodings."""
