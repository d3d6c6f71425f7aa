"""Operators for training-data corpora: tokens, duplicates, languages, privacy, packing, shards.

Every module is one operator with its own interface; ``queries`` registers one query each.
Nothing outside this folder imports it.
"""
