"""Training-data operators: mixing, filtering, dedup, search, sharding, encoding."""
