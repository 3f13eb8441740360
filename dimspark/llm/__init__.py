"""Training-data operators: deduplication, quality, toxicity, packing, output.

Nothing else in the library imports this package.
"""
