"""Training-data operators: near-duplicates, extraction, filters, mixing and tokens."""
