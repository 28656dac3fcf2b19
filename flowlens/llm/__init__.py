"""Training-data operators: quality, scoring, mixing, classification, deduplication, decontamination, token counts."""
