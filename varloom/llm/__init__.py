"""Training-data operators: secrets, dedup, WARC, extraction, packing and the like.

Nothing outside this subpackage imports it.
"""
