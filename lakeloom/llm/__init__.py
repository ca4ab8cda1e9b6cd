"""Training-data operators: sharding, de-duplication, mixing, extraction, scans, packing.

Nothing else in the library imports this subpackage. ``catalogue`` registers its queries.
"""
