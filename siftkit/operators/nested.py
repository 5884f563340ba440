"""Repeated records: unnesting and per-group aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import not_blank


PARTS = 16              # salted parts of a group whose values are listed


def valid_kv(entries: Column, key_field: str = "key", val_field: str = "val") -> Column:
    """N16 filter: key/value entries whose value is non-null and non-empty."""
    return F.filter(entries, lambda e: not_blank(e[val_field]))


def kv_value(key: Column, val: Column, keys: Sequence[str]) -> Column:
    """A6/A7 input: the value when the key is one of ``keys`` (several keys may feed one column)."""
    cond = key == F.lit(keys[0]) if len(keys) == 1 else key.isin(*keys)
    return F.when(cond, val)


def kv_pivot(df: DataFrame, group_keys: Sequence[str], entries: str,
             spec: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """One row per group, ``MAX(IF(key IN keys, val, NULL))`` per output column.

    Entries with a blank value are ignored, but the group is kept with all
    columns null (left unnest semantics, N16).
    """
    exploded = df.select(*group_keys, F.explode_outer(valid_kv(F.col(entries))).alias("__e"))
    aggs = [F.max(kv_value(F.col("__e.key"), F.col("__e.val"), keys)).alias(name) for name, keys in spec]
    return exploded.groupBy(*group_keys).agg(*aggs)


def sorted_distinct_join(values: Column, sep: str = ",") -> Column:
    """A5 finish: distinct values sorted and joined; null when there are none."""
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), sep))


def collect_distinct_string(df: DataFrame, group_keys: Sequence[str], array_col: str,
                            field: str, out: str, sep: str = ",") -> DataFrame:
    """N15 + A5: STRING_AGG(DISTINCT x.field) over an inner unnest, blank values dropped.

    Three levels, so that a hot group is one buffer nowhere before its end:
    distinct (group, value) by an aggregation on both; sorted lists of each
    group's salted parts (the salt is the value's hash, ``PARTS`` of them);
    one merge of at most ``PARTS`` lists per group. Values met again are
    gone before any list is built, and no set is kept. Groups without any
    valid value are absent (as with an inner unnest).
    """
    items = df.select(*group_keys, F.explode(F.col(array_col)[field]).alias("__x")).where(not_blank(F.col("__x"))).distinct()
    parts = items.groupBy(*group_keys, F.pmod(F.xxhash64("__x"), F.lit(PARTS)).alias("__part")).agg(
        F.array_sort(F.collect_list("__x")).alias("__sorted"))
    return parts.groupBy(*group_keys).agg(
        F.array_join(F.array_sort(F.flatten(F.collect_list("__sorted"))), sep).alias(out))


def explode_path(df: DataFrame, keep: Sequence[str], array_expr: Column, out: str) -> DataFrame:
    """Comma unnest of a computed array; null or empty arrays drop the row."""
    return df.select(*keep, F.explode(array_expr).alias(out))


def explode_two_levels(df: DataFrame, keep: Sequence[str], outer: str, outer_filter: Column | None,
                       inner_field: str, outer_fields: Sequence[str], out: str) -> DataFrame:
    """Unnest an array of records, then an array inside each record.

    The record-level filter is applied between the two unnests so that the
    inner arrays of discarded records are never expanded.
    """
    level1 = df.select(*keep, F.explode(F.col(outer)).alias("__r"))
    if outer_filter is not None:
        level1 = level1.where(outer_filter)
    return level1.select(
        *keep,
        *[F.col(f"__r.{f}").alias(f) for f in outer_fields],
        F.explode(F.col(f"__r.{inner_field}")).alias(out),
    )
