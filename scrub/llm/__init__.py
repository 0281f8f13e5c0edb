"""Operators of a training-data pipeline: duplicates, language, quality, shards, token files, packing.

Nothing else in the library imports this subpackage.
"""
