"""Joins whose hot keys are split over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_HOT = 512           # hot keys at any input size
HOT_ROWS = 10_000        # rows below which a key is never split


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS, most: int = MOST_HOT) -> DataFrame:
    """(key, salts) for keys with more than ``hot_rows`` rows and more than 1 / ``most`` of all rows.

    Fewer than ``most`` keys can have that share, so the result is bounded at any size. Counts
    are partial before their shuffle. A key gets a salt for every ``hot_rows`` or share rows.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    share = F.greatest(F.lit(hot_rows), F.ceil(total / most)).cast("long")
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
            .withColumn("__share", share).where(F.col("__n") > F.col("__share"))
            .select(key, F.ceil(F.col("__n") / F.col("__share")).cast("int").alias("__salts")))


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: Column, hot_rows: int = HOT_ROWS,
                most: int = MOST_HOT) -> DataFrame:
    """Inner join on the column ``key`` of both sides; rows of a hot key of ``left`` are dealt by ``spread``.

    The rows of ``right`` with a hot key are repeated once a salt, all others go once. The pairs are
    those of a plain join; null keys match nothing.
    """
    hot = F.broadcast(hot_keys(left, key, hot_rows, most))          # fewer than ``most`` rows
    salt = F.pmod(F.xxhash64(spread), F.col("__salts"))
    dealt = (left.join(hot, key, "left").withColumn("__salt", F.coalesce(salt, F.lit(0).cast("long"))).drop("__salts"))
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("__salts").cast("long"), F.lit(1).cast("long")) - 1)
    repeated = right.join(hot, key, "left").withColumn("__salt", F.explode(copies)).drop("__salts")
    return dealt.join(repeated, [key, "__salt"]).drop("__salt")
