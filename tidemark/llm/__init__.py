"""Training-data operators: language ID, quality, packing, similarity joins,
WARC, personal data, decontamination, HTML text, repeated passages, secrets."""
