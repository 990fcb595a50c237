"""Training-data operators: scans, counts, packing, near-duplicates and extraction."""
