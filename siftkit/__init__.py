"""siftkit: on-site search analytics as Spark DataFrame jobs.

Jobs (``siftkit.plans``): search impressions and clicks, category paths and
mapping, keyword facts, exact and fuzzy keyword intent, category enrichment.
Reusable operators live in ``siftkit.operators``, column functions in
``siftkit.functions`` and table I/O in ``siftkit.sources``.
"""

__version__ = "0.1.0"
