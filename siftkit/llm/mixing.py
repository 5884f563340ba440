"""Operator 2: mixing sources to target weights by Sainte-Laguë quotas over equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, global_order, prepare, store, table, text_hash

WEIGHTS = (3, 1, 2)     # by place of the source in code point order, repeating
SHARE_PCT = 150         # the mix holds this share of all words
MAX_REPEATS = 2         # no source (and no document) beyond so many times its size
BLOCK = 64              # words in a block
SHARDS = 8
GRID = 33               # divisors tried at once


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share_pct: int = SHARE_PCT,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, source_size): one row per source.

    Sources in code point order (null last) weigh ``weights``, repeating;
    each gets its weight's part of the mix, but at most ``max_repeats``
    times its size, and what is over goes to the others by weight until none
    is above. In order of cap / weight the capped sources come first, so the
    final level follows from prefix sums: no round-by-round loop, and no
    source table in one task.
    """
    ranked = global_order(sizes.withColumn("__null", F.col("source").isNull().cast("int"))
                          .withColumn("__key", F.col("source").cast("binary")),
                          ["__null", "__key"], [], "mix-rank").drop("__null", "__key")
    w = F.array(*[F.lit(int(x)) for x in weights])
    ranked = (ranked.withColumn("weight", F.get(w, F.pmod(F.col("idx"), F.lit(len(weights))).cast("int")).cast("long"))
              .withColumn("cap", F.col("source_size") * max_repeats)
              .withColumn("ratio", F.col("cap") / F.col("weight")).drop("idx"))
    level = store(global_order(ranked, ["ratio"], ["cap", "weight"], "mix-level"), "mix-caps")
    words, all_weights = level.agg(F.sum("source_size"), F.sum("weight")).first()
    if not words:
        return level.select("source", "source_size", F.lit(0.0).alias("target"))
    total = words * share_pct / 100
    # with the sources before this one at their caps, the others share the rest at this level
    rate = (F.lit(total) - F.col("before_cap")) / (F.lit(all_weights) - F.col("before_weight"))
    final = level.filter(rate <= F.col("ratio")).agg(F.min(F.struct("idx", rate.alias("rate")))).first()[0]
    rate = final["rate"] if final else float("inf")
    return level.select("source", "source_size", F.least(F.col("cap").cast("double"),
                                                        F.col("weight") * F.lit(rate)).alias("target"))


def sainte_lague(parties: DataFrame, houses: Sequence[int]) -> DataFrame:
    """Seats by highest quotients votes / (2k + 1), for each house size in ``houses``.

    ``parties`` has (key columns, votes double, seats_max long). A party's
    seats are its votes over a common divisor, rounded; the divisor that
    fills each house is narrowed by trying a grid of divisors in one
    aggregation. Seats left by equal quotients go to the parties whose next
    quotient is highest, ties by key. Adds ``seats`` array<long>, one entry
    per house. No seat beyond ``seats_max``.
    """
    houses = [int(h) for h in houses]
    keys = [c for c in parties.columns if c not in ("votes", "seats_max")]
    top, votes, n = parties.agg(F.max("votes"), F.sum("votes"), F.count("*")).first()
    if not top or not houses:
        return parties.withColumn("seats", F.array(*[F.lit(0).cast("long") for _ in houses]))

    def seats_at(d: Column) -> Column:
        return F.least(F.floor(F.col("votes") / d + F.lit(0.5)), F.col("seats_max"))

    # rounding moves each party by half a seat at most, which brackets the divisor
    low = [votes / (h + n / 2 + 1) for h in houses]
    high = [min(2.5 * top, votes / (h - n / 2 - 1)) if h > n / 2 + 1 else 2.5 * top for h in houses]
    exact = [False] * len(houses)
    for _ in range(16):
        grid = [[lo + (hi - lo) * i / (GRID - 1) for i in range(GRID)] for lo, hi in zip(low, high, strict=True)]
        flat = F.lit([d for ds in grid for d in ds])
        tried = (parties.select(F.posexplode(F.transform(flat, seats_at)).alias("pos", "s"))
                 .groupBy("pos").agg(F.sum("s").alias("s")).collect())   # GRID rows a house
        count = {r["pos"]: r["s"] for r in tried}
        for h, house in enumerate(houses):
            at = [count[h * GRID + i] for i in range(GRID)]
            fits = next((i for i in range(GRID) if at[i] <= house), GRID - 1)
            exact[h] = at[fits] == house
            high[h], low[h] = grid[h][fits], grid[h][max(fits - 1, 0)]
        if all(exact):
            break
    base = store(parties.select(*keys, "votes", "seats_max", F.transform(F.lit(high), seats_at).alias("seats")),
                 "mix-seats")
    given = base.agg(*[F.sum(F.get("seats", h)).alias(f"g{h}") for h in range(len(houses))]).first()
    for h, house in enumerate(houses):
        left = house - (given[h] or 0)
        if left > 0:   # at most the parties whose quotients tie at the divisor
            k = F.get("seats", F.lit(h))
            more = (base.filter(k < F.col("seats_max"))
                    .orderBy((F.col("votes") / (2 * k + 1)).desc(), *keys).limit(int(left))
                    .select(*[F.col(c).alias(f"__m_{c}") for c in keys], F.lit(1).cast("long").alias("__more")))
            same = [F.col(c).eqNullSafe(F.col(f"__m_{c}")) for c in keys]
            base = store(base.join(more, same, "left").select(
                *keys, "votes", "seats_max", F.transform("seats", _raise_at(h)).alias("seats")), "mix-seats")
    return base


def _raise_at(h: int):
    return lambda x, i: F.when(i == h, x + F.coalesce(F.col("__more"), F.lit(0))).otherwise(x)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       n_words(F.col(text_col)).alias("size"), text_hash(F.col(text_col)).alias("text_hash"))
    return store(rows, "mix-sizes")


def _quotas(rows: DataFrame, weights: Sequence[int], share_pct: int, max_repeats: int, block: int,
            shards: int) -> DataFrame:
    """One row per source: source_size, target, n (its blocks), quota (blocks dealt to it), quotas (by shard)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share_pct, max_repeats)
    parties = store(targets.select("source", "source_size", "target", F.col("target").alias("votes"),
                                   (F.ceil(F.col("source_size") / block) * max_repeats).alias("seats_max")),
                    "mix-targets")
    n_blocks = parties.agg(F.floor(F.sum("target") / block + F.lit(0.5))).first()[0] or 0
    plan = sainte_lague(parties, [n_blocks * (j + 1) // shards for j in range(shards)])
    return plan.select(
        "source", "source_size", "target", F.ceil(F.col("source_size") / block).alias("n"),
        F.element_at("seats", -1).alias("quota"),
        F.transform("seats", lambda x, i: x - F.when(i > 0, F.get("seats", i - 1)).otherwise(0)).alias("quotas"))


def _streams(rows: DataFrame, plan: DataFrame, order: Sequence[str]) -> DataFrame:
    """The documents of each source in ``order``: before_size - source_start words of the source stand before one."""
    placed = global_order(rows.withColumn("__null", F.col("source").isNull().cast("int")),
                          ["__null", "source", *order], ["size"], "mix-stream")
    placed = store(placed.drop("idx", "__null"), "mix-place")
    first = placed.groupBy("source").agg(F.min("before_size").alias("source_start"))
    info = store(plan.join(first, plan["source"].eqNullSafe(first["source"])).drop(first["source"]), "mix-plan")
    info = info.withColumnRenamed("source", "__source")
    return placed.join(info, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share_pct: int = SHARE_PCT,
                max_repeats: int = MAX_REPEATS, block: int = BLOCK, shards: int = SHARDS, seed: int = 17,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Mix the documents to the targets of :func:`source_targets`.

    The words of a source, its documents in order of id, form a stream of
    blocks of ``block`` words (the last may be shorter). All blocks of the
    mix are dealt to the sources by Sainte-Laguë with the targets as votes;
    the house grows shard by shard, so the differences are integer quotas
    per shard and source. A seeded affine permutation of a source's blocks
    says which are taken: places 0 to quota - 1 of the permutation, in
    passes over all blocks, each shard the places of its quota. ``taken`` is
    the number of the document's words in taken blocks, a block taken twice
    counting twice; no block is taken more than ``max_repeats`` times.

    Only (id, size, source) is shuffled. A hot source is spread over range
    partitions. Null text: size 0, nothing taken. A null source is a source
    of its own, the last. A source of size 0 has target 0. Long texts are cut
    by block like all others. Rows equal in id are told apart by their place
    in the input. No rows: no rows. Extra columns are ignored.

    Returns doc_id, size, source_size, target, taken, source, quotas (the
    source's blocks by shard), passes (the document's words taken by pass),
    text_hash.
    """
    rows = _sized(docs, id_col, text_col, source_col)
    plan = _quotas(rows, weights, share_pct, max_repeats, block, shards)
    out = _streams(rows, plan, ["doc_id", "size"])
    start = F.col("before_size") - F.col("source_start")
    # block b stands at place (b * step + shift) mod n of its source's permutation; step is prime and n no multiple
    step, shift = F.when(F.col("n") % 1000003 == 0, F.lit(999983)).otherwise(F.lit(1000003)).cast("long"), \
        F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.lit(seed)), F.greatest(F.col("n"), F.lit(1)))
    out = out.withColumns({"__a": start, "__b": start + F.col("size"), "__step": step, "__shift": shift})

    def words_in(b: Column) -> Column:
        return F.least(F.col("__b"), (b + 1) * block) - F.greatest(F.col("__a"), b * block)

    def place(b: Column) -> Column:
        return ((b * F.col("__step")) % F.col("n") + F.col("__shift")) % F.col("n")

    blocks = F.sequence(F.floor(F.col("__a") / block), F.floor((F.col("__b") - 1) / block))
    passes = F.transform(F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda p: F.aggregate(
        blocks, F.lit(0).cast("long"),
        lambda s, b: s + F.when(place(b) + p * F.col("n") < F.col("quota"), words_in(b)).otherwise(0)))
    none = F.array(*[F.lit(0).cast("long")] * max_repeats)
    out = out.withColumn("passes", F.when(F.col("size") > 0, passes).otherwise(none))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda s, x: s + x)
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "quotas", "passes",
                      "text_hash")


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share_pct: int = SHARE_PCT,
                  max_repeats: int = MAX_REPEATS, block: int = BLOCK, seed: int = 17, id_col: str = "doc_id",
                  text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix of :func:`mix_sources` in whole documents.

    A source's quota of blocks, in words, is filled with its documents in
    seeded random order, pass after pass over all of them. The document at
    the end of the quota is taken if at least half of it lies inside, so
    what is taken misses the quota by at most half a document, whatever the
    lengths; a source whose quota is under half of its first document gives
    nothing. Documents without words are never taken.

    Returns doc_id, size, source_size, target, quota (words), copies, source,
    text_hash.
    """
    rows = _sized(docs, id_col, text_col, source_col)
    plan = _quotas(rows, weights, share_pct, max_repeats, block, 1)
    rows = rows.withColumn("__draw", F.xxhash64("doc_id", "text_hash", F.lit(seed)))
    out = _streams(rows, plan, ["__draw", "doc_id", "text_hash"])
    start = F.col("before_size") - F.col("source_start")
    quota = F.least(F.col("quota") * block, F.col("source_size") * max_repeats)
    inside = [(2 * (p * F.col("source_size") + start) + F.col("size") <= 2 * quota).cast("int")
              for p in range(max_repeats)]
    copies = F.when(F.col("size") > 0, sum(inside[1:], inside[0])).otherwise(0)
    return out.select("doc_id", "size", "source_size", "target", quota.alias("quota"), copies.alias("copies"),
                      "source", "text_hash")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mix_sources(table(spark, sf_dir, "documents")).drop("text_hash")
