"""Training-data operators: formatting, token counts, deduplication, filtering, mixing."""
