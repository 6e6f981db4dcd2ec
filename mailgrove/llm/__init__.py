"""Training-data operators: language ID, near-duplicates, toxicity, tokens, packing, search and licences."""
