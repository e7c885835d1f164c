"""Operators that prepare training text: packing, near-duplicate search, extraction, counting, scoring, cleaning."""
