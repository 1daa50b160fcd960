"""Operators for building training corpora: extraction, scoring, search, near-duplicates, decontamination, mixing."""
