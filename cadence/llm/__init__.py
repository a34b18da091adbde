"""Operators for preparing training data: tokenization, search, deduplication,
scanning, quality, packing, sharding and token files.

Every operator is a function from DataFrames to DataFrames. Nothing else in
the library imports this subpackage; it imports only general helpers.
"""
