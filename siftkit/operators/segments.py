"""Segment join (N12): strings within an edit distance, found by shared segments.

If ``levenshtein(a, b) <= k`` and b is cut into k + 1 segments, at least one
segment of b stands unchanged in a, because k edits touch at most k of them.
So b is looked up by its segments, and a by the substrings that could be
one: of each length of b within reach, of each segment, at the few places
to which edits left of it can have moved it. Keys are linear in the string's
length (unlike strings with k characters deleted), at most (k + 1)^2 for
each length of b: 16 x 7 for k = 3, whatever the length of a. Any k works.

Short dictionary strings often share a segment with most others (numbered
names), so up to :data:`SHORT` characters and k <= 2 the key is the string with up
to k characters deleted: equal for two strings within k edits, at most 301
keys. Both kinds of keys meet in one join; every match is found either way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_char
from .nearest import nearest_by_keys

Threshold = Callable[[Column], Column]
SHORT = 24
_NO_KEYS = "array<struct<k:int,len:int,seg:int,piece:string>>"


def segment_start(length: Column, k: Column, i: Column) -> Column:
    """0-based start of segment i of a string of ``length`` cut into k + 1; the last ones are one longer."""
    size = F.floor(length / (k + 1)).cast("int")
    longer = length - size * (k + 1)
    return i * size + F.greatest(F.lit(0), i - (k + 1 - longer))


def _piece(s: Column, start: Column, length: Column) -> Column:
    return F.substr(s, start + 1, length)


def _without(s: Column, n: Column, k: Column) -> Column:
    """Array of (k, -1, -1, piece): ``s`` with at most ``k`` (<= 2) characters deleted."""
    none = F.array().cast("array<string>")

    def cut(t: Column, size: Column, first: Column) -> Column:
        """``t`` (of ``size`` characters) without its i-th character, for every i from ``first``."""
        return F.when(size >= first, F.transform(F.sequence(first, size), lambda i: F.concat(
            F.substr(t, F.lit(1), i - 1), F.substr(t, i + 1, size)))).otherwise(none)
    one = F.when(k >= 1, cut(s, n, F.lit(1))).otherwise(none)
    two = F.when((k >= 2) & (n >= 2), F.flatten(F.transform(one, lambda t, i: cut(t, n - 1, i + 1)))).otherwise(none)
    return F.transform(F.array_distinct(F.concat(F.array(s), one, two)), lambda piece: F.struct(
        k.alias("k"), F.lit(-1).alias("len"), F.lit(-1).alias("seg"), piece.alias("piece")))


def own_segments(s: Column, n: Column, k: Column) -> Column:
    """Array of (k, len, seg, piece): the k + 1 segments of a dictionary string."""
    return F.transform(F.sequence(F.lit(0), k), lambda i: F.struct(
        k.alias("k"), n.alias("len"), i.alias("seg"),
        _piece(s, segment_start(n, k, i), segment_start(n, k, i + 1) - segment_start(n, k, i)).alias("piece")))


def probe_segments(s: Column, n: Column, k: Column, gap: int, above: int = -1) -> Column:
    """Array of distinct (k, len, seg, piece): what a dictionary string within ``k`` edits has one of.

    For a dictionary string of length l, a segment at p stands in ``s`` at p + shift with
    |shift| + |n - l - shift| <= k, since edits left and right of it add up to at most k.
    Only lengths ``above`` the given one are looked for.
    """
    reach = F.least(k, F.lit(gap))

    def of_length(length: Column) -> Column:
        low = F.ceil((n - length - k) / 2).cast("int")
        high = F.floor((n - length + k) / 2).cast("int")

        def of_segment(i: Column) -> Column:
            p = segment_start(length, k, i)
            size = segment_start(length, k, i + 1) - p
            first, last = F.greatest(p + low, F.lit(0)), F.least(p + high, n - size)
            return F.when(first <= last, F.transform(F.sequence(first, last), lambda at: F.struct(
                k.alias("k"), length.alias("len"), i.alias("seg"), _piece(s, at, size).alias("piece"))))
        return F.flatten(F.filter(F.transform(F.sequence(F.lit(0), k), of_segment), lambda x: x.isNotNull()))
    lengths = F.filter(F.sequence(F.greatest(n - reach, F.lit(0)), n + reach), lambda x: x > above)
    return F.array_distinct(F.flatten(F.transform(lengths, of_length)))


def segment_candidates(queries: DataFrame, key: str, text: str, dictionary: DataFrame, value: str,
                       threshold: Threshold, max_gap: int, max_limit: int, same_first: bool = True,
                       tags: Sequence[str] = (), nearest: bool = False) -> DataFrame:
    """Distinct pairs (key, value, distance) with a length gap of at most ``max_gap`` and
    ``levenshtein <= threshold(length of the query)``, a non-decreasing step function of at most ``max_limit``.

    With ``same_first`` the first characters must be equal too, as part of the join key.
    ``tags`` are columns of both sides that must be equal and come back (several dictionaries in one join).
    Pairs met by several segments are reduced to one before the distance is computed. Null strings match nothing.

    With ``nearest`` only pairs that can be a key's best are needed: among them are all of the smallest
    distance's smallest value. Dictionary strings of up to :data:`SHORT` characters are then searched by :mod:`.nearest`,
    without pairs, and only longer ones by their segments.
    """
    tags = list(tags)
    fc = (lambda c: first_char(F.col(c))) if same_first else (lambda c: F.lit(""))
    # no null filter here: it would evaluate a Python-side normaliser twice, and null pieces never join
    d = dictionary.select(*tags, F.col(value).alias("__val")).distinct()
    d = d.withColumn("__dlen", F.length("__val")).withColumn("__dfc", fc("__val"))
    # queries outside every (first character, length) block of the dictionary cannot match
    blocks = d.select(*tags, F.col("__dfc").alias("__bfc"),
                      F.explode(F.sequence(F.col("__dlen") - max_gap, F.col("__dlen") + max_gap)).alias("__blen")).distinct()
    q = (queries.select(*tags, key, text).where(F.col(text).isNotNull()).distinct()
         .withColumn("__len", F.length(text)).withColumn("__t", threshold(F.col("__len")).cast("int"))
         .withColumn("__fc", fc(text)))
    blocks = blocks.withColumnsRenamed({"__bfc": "__fc", "__blen": "__len"})
    q = q.join(blocks, [*tags, "__fc", "__len"], "left_semi")
    short = SHORT if max_limit <= 2 else -1
    by_keys = None
    if nearest and short >= 0:
        by_keys = nearest_by_keys(
            q.where(F.col("__len") - max_gap <= short).withColumnsRenamed({"__fc": "__first"}), key, text,
            d.where(F.col("__dlen") <= short).withColumnsRenamed({"__val": value, "__dfc": "__first"}), value,
            "__first", "__t", max_gap, max_limit, tags)
        q, d = q.where(F.col("__len") + max_gap > short), d.where(F.col("__dlen") > short)
    by_segment = probe_segments(F.col(text), F.col("__len"), F.col("__t"), max_gap, short)
    if short >= 0 and by_keys is None:
        by_segment = F.concat(by_segment, F.when(
            F.col("__len") - max_gap <= short, _without(F.col(text), F.col("__len"), F.col("__t"))).otherwise(
                F.array().cast(_NO_KEYS)))
    probes = q.select(*tags, key, text, "__t", "__fc", F.explode(by_segment).alias("p"))
    # a dictionary string is cut for each threshold that a query in reach of its length can have
    least, most = threshold(F.greatest(F.col("__dlen") - max_gap, F.lit(0))), threshold(F.col("__dlen") + max_gap)
    cut = d.withColumn("__k", F.explode(F.sequence(least.cast("int"), most.cast("int"))))
    owns = cut.select(*tags, "__val", F.col("__dfc").alias("__fc"),
                      F.explode(F.when(F.col("__dlen") <= short, _without(F.col("__val"), F.col("__dlen"), F.col("__k")))
                                .otherwise(own_segments(F.col("__val"), F.col("__dlen"), F.col("__k")))).alias("p"))
    keys = [F.col(f"p.{f}").alias(f"__{f}") for f in ("k", "len", "seg", "piece")]
    on = [*tags, "__fc", "__k", "__len", "__seg", "__piece"]
    # the planner takes an exploded side for as small as its input, so it must be told not to broadcast it
    pairs = (probes.select(*tags, key, text, "__t", "__fc", *keys).join(owns.select(*tags, "__val", "__fc", *keys).hint("merge"), on)
             .select(*tags, key, text, "__t", "__val").distinct())
    found = (pairs.withColumn("distance", F.levenshtein(F.col(text), F.col("__val"), max_limit))
             .where((F.col("distance") >= 0) & (F.col("distance") <= F.col("__t")))
             .select(*tags, key, F.col("__val").alias(value), "distance"))
    return found if by_keys is None else found.unionByName(by_keys)
