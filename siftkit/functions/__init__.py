"""Column functions: channels and zones, paths and predicates, text normalisation."""
