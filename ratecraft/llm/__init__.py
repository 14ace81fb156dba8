"""Operators of a training-data pipeline: search, dedup, language ID, mixing, packing, sharding.

Nothing else in the library imports this subpackage.
"""
