"""Operators that prepare training text: filters, deduplication, scoring, formatting and mixing."""
