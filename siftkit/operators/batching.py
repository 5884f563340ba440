"""Stable batch assignment.

Positional batches (``position // size`` in term order) need a global row
number. ``ROW_NUMBER() OVER (ORDER BY term)`` without a partition moves
every row to one task; here the sort is range-partitioned, each row gets
its index inside its partition, and a per-partition offset (one row per
partition, so a bounded broadcast) turns that into the global position.
The sorted, numbered rows are written once so both uses read the same
partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Stage = Callable[[DataFrame, str], DataFrame]


def global_positions(df: DataFrame, order_cols: str | list[str], stage: Stage) -> DataFrame:
    """Adds ``position`` (0-based rank in the order of ``order_cols``, nulls first; their values must be unique together)."""
    numbered = stage(
        df.orderBy(order_cols)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id()),
        "positions",
    )
    per_part = numbered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    offsets = per_part.select(
        "__pid", "__first",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    )
    out = numbered.join(F.broadcast(offsets), "__pid")
    pos = F.coalesce(F.col("__off"), F.lit(0)) + (F.col("__mid") - F.col("__first"))
    return out.select(*df.columns, pos.alias("position"))


def assign_batches(terms: DataFrame, term_col: str, batch_size: int, stage: Stage,
                   method: str = "ordered") -> DataFrame:
    """``batch_id``, ``total_batches`` and the batch's [start, end) positions.

    ``ordered``: positional batches of exactly ``batch_size`` terms in term
    order (the last one shorter). ``hash``: ``pmod(xxhash64(term), total)``,
    no sort, a term keeps its batch while the set grows, sizes vary.
    """
    n = terms.select(F.count(F.lit(1))).scalar()
    total = F.ceil(n / F.lit(batch_size)).cast("long")
    if method == "hash":
        out = terms.withColumn("batch_id", F.pmod(F.xxhash64(F.col(term_col)), total))
        return out.withColumn("total_batches", total)
    pos = global_positions(terms, term_col, stage)
    batch = F.floor(F.col("position") / F.lit(batch_size)).cast("long")
    return pos.select(
        *terms.columns, "position", batch.alias("batch_id"), total.alias("total_batches"),
        (batch * F.lit(batch_size)).alias("batch_start"),
        F.least((batch + 1) * F.lit(batch_size), n).alias("batch_end"),
    )
