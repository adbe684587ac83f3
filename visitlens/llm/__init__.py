"""Training-data operators: filtering, dedup, tokenization, search and export."""
