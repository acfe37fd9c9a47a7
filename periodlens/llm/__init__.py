"""Operators for preparing training text: deduplication, scoring, packing, extraction, filters."""
