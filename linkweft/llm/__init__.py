"""Operators for preparing training text: filters, duplicates, packing, formats, archives."""
