"""Operators for preparing training text: filters, deduplication, privacy, tokens.

Nothing else in the library imports this subpackage.  Each module holds one
operator; ``queries`` registers them.
"""
