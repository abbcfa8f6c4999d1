"""Training-data operators: scoring, language, mixing, formatting, WARC, decontamination, near copies."""
