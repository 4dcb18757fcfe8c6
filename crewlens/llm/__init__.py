"""Training-data operators: mixing, search, filtering, deduplication, tokens and scores."""
