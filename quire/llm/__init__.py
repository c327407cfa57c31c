"""Training-data operators: packing, tokenising, filtering, deduplication, search."""
