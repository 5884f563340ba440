"""Training-data operators: sharding, mixing, cleaning, scoring, dedup, extraction, packing.

Nothing else in the package imports this subpackage. It may import general
helpers from the package (reading, storing, shipping code).
"""
