"""Top-1 per group.

``ROW_NUMBER() OVER (PARTITION BY k ORDER BY o) = 1`` needs a sort of every
group in one task. Taking the minimum of a struct of the ordering columns is
the same pick as an aggregation with map-side partial results, so a hot group
is reduced before the shuffle. Spark runs it sort-based when the struct holds
strings. The pick is deterministic because the struct ends with explicit
tie-breakers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   payload: Sequence[str], descending: bool = False) -> DataFrame:
    """One row per group: the payload of the row with the smallest (or largest) ``order``.

    ``order`` must include tie-breakers that make the pick unique; rows with
    a null in the first ordering column are ranked last.
    """
    null_last = order[0].isNotNull() if descending else order[0].isNull()
    fields = [null_last.alias("__null"), *[o.alias(f"__o{i}") for i, o in enumerate(order)]]
    fields += [F.col(p).alias(p) for p in payload]
    ranked = df.select(*keys, F.struct(*fields).alias("__best"))
    pick = F.max if descending else F.min
    out = ranked.groupBy(*keys).agg(pick("__best").alias("__best"))
    return out.select(*keys, *[F.col(f"__best.{p}").alias(p) for p in payload])
