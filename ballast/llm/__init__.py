"""Operators for preparing training text: extraction, cleaning, privacy, formatting, deduplication, mixing, packing."""
