"""Streaming.

The studied jobs are one-shot batch queries: no watermark, window, state or
late-data rule exists in them, so nothing here is a stream processor. The
resumable enrichment (``siftkit.plans.enrich.run_enrichment``) already
gives batch-level progress and idempotent re-runs through partitioned
writes.
"""
