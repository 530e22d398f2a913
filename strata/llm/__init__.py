"""Training-data operators: quality, search, decontamination, deduplication, tokens, packing.

Nothing else in the library imports this subpackage.
"""
