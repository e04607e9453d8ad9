"""Training-data operators: deduplication, tokenising, filtering, formatting and packing."""
