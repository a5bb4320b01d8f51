"""Dataset-level operators: metrics, windows, census analyses, audits, upsert."""
