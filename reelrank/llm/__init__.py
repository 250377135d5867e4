"""Operators for training data: filters, duplicates, mixing, tokens, chat, secrets, licences.

Nothing else in the package imports this one. Its queries are in ``queries``.
"""
