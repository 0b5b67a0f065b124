"""Training-data operators (deduplication, packing, language ID, scoring, sharding)."""
