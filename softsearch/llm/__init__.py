"""Training-data operators: quality, secrets, near duplicates, sampling, formatting, packing, sharding."""
