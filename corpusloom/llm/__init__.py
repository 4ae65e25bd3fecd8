"""Training-data operators: formatting, archives, counting, filtering, deduplication, mixing."""
