"""Operators that prepare training text: deduplicate, judge, redact, mix, encode and score documents.

Nothing else in the library imports this subpackage.
"""
