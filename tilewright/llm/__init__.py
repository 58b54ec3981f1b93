"""Corpus operators for training data: search, de-duplication, filters, tokens, models, mixing.

Nothing else in the library imports this subpackage.
"""
