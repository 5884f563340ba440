"""Closest dictionary value within two edits (N12 + W2), by keys that only true matches share.

An edit script of e edits between strings a and b is w substitutions, x characters of a
left out and y characters of b left out, w + x + y = e. What both strings keep is then one
string: a without x and b without y characters, both without the w substituted characters
at equal places. So the key of a string is what it keeps with these places and the
script's kind (w, x, y). Two strings share a key of kind (w, x, y) only if they are within
e edits, and strings at distance e share one of e edits.

For the closest value it is enough to keep the smallest value of each key: a shared
key proves the distance, so no value but the smallest can win by it. The dictionary is
thus one row a key, and the join gives at most one row for each key of a query, however
alike the values are (numbered names differ in few characters, so pairs grow with their square).

Keys grow with the square of a string's length, so the caller searches only short strings
this way. Two edits are tried only for queries without a value within one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = {0: ((0, 0, 0),), 1: ((1, 0, 0), (0, 1, 0), (0, 0, 1)),
         2: ((2, 0, 0), (1, 1, 0), (1, 0, 1), (0, 2, 0), (0, 1, 1), (0, 0, 2))}
KEY = ("kind", "at", "then", "piece")


def _left_out(piece: Column, size: Column, first: Column) -> Column:
    """Array of (at, piece): the string without its character ``at``, for every place from ``first``."""
    none = F.array().cast("array<struct<at:int,piece:string>>")
    return F.when(size >= first, F.transform(F.sequence(first, size), lambda at: F.struct(
        at.alias("at"), F.concat(F.substr(piece, F.lit(1), at - 1), F.substr(piece, at + 1, size)).alias("piece")))).otherwise(none)


def edit_keys(s: Column, n: Column, kinds: Sequence[tuple[int, int, int]], of_value: bool) -> Column:
    """Array of (kind, at, then, piece), runs of a character repeat some, of a string of ``n`` characters, as a query or as a dictionary value."""
    zero, one = F.lit(0), F.lit(1)

    def key(kind: int, at: Column, then: Column, piece: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), at.alias("at"), then.alias("then"), piece.alias("piece"))

    def keys(w: int, x: int, y: int) -> Column:
        kind, out = 100 * w + 10 * x + y, y if of_value else x
        if (w, out) == (0, 0):
            return F.array(key(kind, zero, zero, s))
        singles = _left_out(s, n, one)
        if w + out == 1:
            return F.transform(singles, lambda a: key(kind, a.at if w else zero, zero, a.piece))
        # of two substitutions or two left out the later place second; after one left out any place is substituted
        return F.flatten(F.transform(singles, lambda a: F.transform(
            _left_out(a.piece, n - 1, one if w == 1 else a.at),
            lambda b: key(kind, a.at if w == 2 else b.at if w == 1 else zero, b.at if w == 2 else zero, b.piece))))
    return F.concat(*[keys(*k) for k in kinds])


def nearest_by_keys(queries: DataFrame, key: str, text: str, values: DataFrame, value: str, first: str, limit: str,
                    max_gap: int, max_limit: int, tags: Sequence[str] = ()) -> DataFrame:
    """(tags, key, value, distance): the closest value of each key and tag, ties to the smallest.

    Both sides have a column ``first``, the first character that must be equal (it is
    left out of the keys), or ''. ``limit`` is the column of a query's most edits, ``max_limit`` (<= 2) its maximum.
    """
    tags = list(tags)
    spark = queries.sparkSession
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)

    def keyed(df: DataFrame, string: str, keep: list[str], edits: Sequence[int], of_value: bool) -> DataFrame:
        """A row for each key. The rows are small and their keys many, so they are dealt to all tasks first."""
        rest = F.when(F.col(first) == "", F.col(string)).otherwise(F.substr(string, F.lit(2)))

        def of(e: int) -> Column:
            keys = edit_keys(rest, F.length(rest), [k for k in KINDS[e] if abs(k[1] - k[2]) <= max_gap], of_value)
            keys = F.transform(keys, lambda x: F.struct(F.lit(e).alias("distance"), x.alias("x")))
            return keys if of_value else F.when(F.col(limit) >= e, keys).otherwise(F.slice(keys, 1, 0))
        found = F.concat(*[of(e) for e in edits])
        dealt = df.repartition(tasks, F.xxhash64(*keep))     # not by the columns as they are: that would be no new shuffle
        return (dealt.select(*tags, *keep, first, F.explode(found).alias("__k"))
                .select(*tags, *keep, first, "__k.distance", *[F.col(f"__k.x.{c}").alias(f"__{c}") for c in KEY]))

    on = [*tags, first, "distance", *[f"__{c}" for c in KEY]]

    def closest(q: DataFrame, v: DataFrame, edits: Sequence[int]) -> DataFrame:
        least = keyed(v, value, [value], edits, True).groupBy(*on).agg(F.min(value).alias(value))
        # the planner takes an exploded side for as small as its input, so it must be told not to broadcast it
        met = keyed(q.select(*tags, key, text, first, limit), text, [key], edits, False).join(least.hint("merge"), on)
        best = met.groupBy(*tags, key).agg(F.min(F.struct("distance", value)).alias("__b"))
        return best.select(*tags, key, F.col(f"__b.{value}").alias(value), F.col("__b.distance").alias("distance"))

    near = closest(queries, values, tuple(range(min(max_limit, 1) + 1)))
    if max_limit < 2:
        return near
    open_ = queries.where(F.col(limit) >= 2).join(near.select(*tags, key).hint("merge"), [*tags, key], "left_anti")
    reach = open_.select(*tags, first, F.explode(F.sequence(F.length(text) - max_gap, F.length(text) + max_gap)).alias("__n"))
    wanted = (values.withColumn("__n", F.length(value)).join(reach.distinct(), [*tags, first, "__n"], "left_semi"))
    return near.unionByName(closest(open_, wanted.drop("__n"), (2,)))
