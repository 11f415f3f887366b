"""Training-corpus operators: tokens, deduplication, filters, decontamination."""
