"""Training-data operators: counting, encoding, near and exact duplicates, quality, privacy, fingerprints."""
