"""Readers: monthly listing CSVs, census CSVs and stored tables."""
