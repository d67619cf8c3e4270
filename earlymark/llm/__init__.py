"""Training-data operators: deduplication, scoring, packing, sharding and archives for text corpora."""
