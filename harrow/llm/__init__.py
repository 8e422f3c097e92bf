"""Training-data operators: tokens, extraction, classification, deduplication, packing.

Nothing outside this subpackage imports it.
"""
