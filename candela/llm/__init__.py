"""Training-data operators: packing, line dedup, quality, similarity joins, tokens, URLs."""
