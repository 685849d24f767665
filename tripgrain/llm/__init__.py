"""Jobs that prepare training text: deduplication, filtering, scoring, mixing, packing, token files."""
