"""Training-data operators: extraction, fingerprints, dedup, search, scoring, mixing, packing."""
