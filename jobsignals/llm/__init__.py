"""Training-data operators: quality, duplicates, mixing, packing, extraction, privacy, scoring."""
