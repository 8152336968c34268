"""Training-data operators: quality, packing, decontamination, toxicity, deduplication, licences, extraction, language."""
