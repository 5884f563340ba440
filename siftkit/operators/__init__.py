"""Reusable DataFrame operators (joins, unnesting, top-1, similarity, batching)."""
