"""Operators for preparing training text: search, counting, scanning, packing, cleaning."""
