"""Edit-distance joins.

Blocked fuzzy matching in the studied SQL joins every keyword with every
dictionary value of the same first character and a length within 2, then
filters by edit distance: all pairs inside a block. Here candidates come
from a join on shared segments (:mod:`.segments`), which pairs only
strings that are near each other and finds every true match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .segments import Threshold, segment_candidates

def step_threshold(short_max_len: int, long_limit: int) -> Threshold:
    """Distance 1 up to ``short_max_len`` characters, ``long_limit`` above (by the query's length)."""
    return lambda length: F.when(length <= short_max_len, F.lit(1)).otherwise(F.lit(long_limit))


def similarity_candidates(queries: DataFrame, key: str, text: str, dictionary: DataFrame, value: str,
                          threshold: Threshold, max_gap: int = 2, max_limit: int = 2, tags: Sequence[str] = (),
                          nearest: bool = False) -> DataFrame:
    """(key, value, distance) for every dictionary value with the same first character,
    a length within ``max_gap`` and ``levenshtein <= threshold(len(query text))``.

    ``threshold`` must be non-decreasing in the length and at most ``max_limit``, whatever that is.
    With ``nearest`` pairs that cannot be a key's best match may be left out: for :func:`best_match`, linear in both sides.
    """
    return segment_candidates(queries, key, text, dictionary, value, threshold, max_gap, max_limit, tags=tags,
                              nearest=nearest)


def best_match(candidates: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """The closest value per key; equal distances go to the smallest value."""
    best = candidates.groupBy(key).agg(F.min(F.struct("distance", value)).alias("__b"))
    return best.select(key, F.col(f"__b.{value}").alias(out))


def keyed_candidates(queries: DataFrame, key: str, text: str, values: DataFrame, value: str,
                     threshold: Threshold, max_limit: int = 2, tags: Sequence[str] = ()) -> DataFrame:
    """Edit distance between each query and the values listed for the same key (and tags; no blocking)."""
    tags = list(tags)
    q = (queries.select(*tags, key, text).where(F.col(text).isNotNull()).distinct()
         .withColumn("__t", threshold(F.length(text))))
    pairs = q.join(values.select(*tags, key, value), [*tags, key], "inner")   # null values get a null distance
    dist = F.levenshtein(F.col(text), F.col(value), max_limit)
    return (pairs.select(*tags, key, value, dist.alias("distance"), "__t")
            .where((F.col("distance") >= 0) & (F.col("distance") <= F.col("__t")))
            .select(*tags, key, value, "distance"))
