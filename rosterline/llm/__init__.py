"""Operators for large text corpora: filters, secret scans, token counts, quality, mixing, near-duplicates, fingerprints."""
