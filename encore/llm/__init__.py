"""Training-data operators: deduplication, quality, mixing, tokens, archives.

Nothing else in the library imports this package.  Each module holds one
operator; ``queries`` registers them over the driver tables.
"""
