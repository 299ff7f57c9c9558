"""Operators of a training-data corpus: filter, dedup, decontaminate, mix, shard, encode.

Nothing else in the library imports this subpackage.
"""
