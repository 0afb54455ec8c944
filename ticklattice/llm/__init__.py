"""Training-data operators: packing, sharding, deduplication, search and scanning over text tables."""
