"""Set membership joins.

``NOT IN (subquery)`` is null-aware: a null in the set removes every row,
and a null key survives only when the set is empty. Spark plans the SQL form
as a broadcast-only null-aware join, so the build side must fit in memory.
Here the two facts that matter (set size, nulls in the set) come from a
one-row scalar subquery and the membership itself is an ordinary
``left_anti`` join that may shuffle. Keys are made distinct first (with
map-side partial results), so a hot key on the build side is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def semi_join(df: DataFrame, keys: DataFrame, left: Column, right: Column) -> DataFrame:
    """Rows whose key is IN the other relation (nulls never match)."""
    probe = keys.select(right.alias("__member_key")).where(F.col("__member_key").isNotNull()).distinct()
    return df.join(probe, left == F.col("__member_key"), "left_semi")


def null_aware_anti_join(df: DataFrame, keys: DataFrame, left: Column, right: Column) -> DataFrame:
    """Rows where ``left NOT IN (SELECT right FROM keys)`` is TRUE."""
    members = keys.select(right.alias("__member_key"))
    stats = members.select(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("__member_key").isNull()).alias("nulls"),
        )
    ).scalar()
    survivors = df.where(
        (stats.getField("n") == 0)
        | ((stats.getField("nulls") == 0) & left.isNotNull())
    )
    present = members.where(F.col("__member_key").isNotNull()).distinct()
    return survivors.join(present, left == F.col("__member_key"), "left_anti")


def in_either(df: DataFrame, first: DataFrame, second: DataFrame, left: Column,
              right_first: Column, right_second: Column) -> DataFrame:
    """``x IN (set A) OR x IN (set B)`` as one semi join with the union of both sets."""
    union = first.select(right_first.alias("__k")).unionByName(second.select(right_second.alias("__k")))
    return semi_join(df, union, left, F.col("__k"))
