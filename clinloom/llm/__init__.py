"""Training-data operators: mixing, sharding, search, token files, de-duplication, filters."""
