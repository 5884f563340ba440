"""Operator 13: exact duplicates by content sort, SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import store, table

PREFIX = 32              # leading characters in the sort key; splitters stay this short
BUCKETS = 1 << 20        # hash buckets in which hot contents are looked for
HOT_ROWS = 1000          # a bucket below this many rows is never split


def hot_buckets(keyed: DataFrame, buckets: int = BUCKETS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows (b, salts) for the hash buckets with far more rows than the others.

    Counting shuffles one partial count per bucket and task. A bucket is hot above
    ``hot_rows`` rows and above four times the mean; it gets a salt for each
    such share. At most ``buckets`` rows come out at any input size.
    """
    share = max(hot_rows, 4 * keyed.count() // buckets)
    return (keyed.groupBy("b").agg(F.count("*").alias("n")).filter(F.col("n") > share)
            .select("b", F.ceil(F.col("n") / share).cast("int").alias("salts")))


def exact_duplicates(docs: DataFrame, normalise: Callable[[Column], Column] | None = None, keep: str = "max",
                     id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Classes of rows whose normalised texts are the same bytes; one row of each stays.

    The sort key is the leading characters of the text, a hash of the whole
    text and a salt. Spark samples it for splitters, range-partitions the rows
    and sorts each partition on disk, so equal texts are adjacent; each row's
    whole text is then compared with the neighbour's before it. The salt is 0
    but for rows in hot buckets (:func:`hot_buckets`): their copies are dealt over
    neighbouring ranges, each run is reduced to one row there, and only those
    rows meet, again by whole text, so no task holds all copies of a hot text.
    Texts are shuffled once.

    ``keep`` is ``"max"`` or ``"min"``: the id that stays. ``normalise`` maps
    the text column (default: no change). Null and empty texts are equal.
    Null ids come last; a class of null ids keeps one row with a null
    ``keep_id``. Rows equal in id and text: one of them is kept. Repeated rows each
    count. No rows: no rows. Extra columns, also of the names used here, are
    ignored.

    Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    if keep not in ("max", "min"):
        raise ValueError("keep is 'max' or 'min'")
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("id"),
                       (F.coalesce(normalise(text), F.lit("")) if normalise else text).alias("t"))
    keyed = base.withColumn("h", F.xxhash64("t")).withColumn("b", F.pmod("h", F.lit(BUCKETS)))
    hot = store(hot_buckets(keyed.select("b"), BUCKETS, hot_rows), "exact-hot")
    salted = (keyed.join(F.broadcast(hot), "b", "left")
              .withColumn("salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("id"), F.col("salts")) + 1)
                          .otherwise(0).cast("int"))
              .select("id", "t", "h", "salt", F.substring("t", 1, PREFIX).alias("p")))

    best = F.col("id").desc_nulls_last() if keep == "max" else F.col("id").asc_nulls_last()
    by_key = Window.partitionBy("p", "h", "salt").orderBy("t", best)
    starts = F.coalesce(F.lag("t").over(by_key) != F.col("t"), F.lit(True))     # the full comparison
    near = (salted.repartitionByRange("p", "h", "salt").withColumn("starts", starts)
            .withColumn("run", F.sum(F.col("starts").cast("int")).over(by_key.rowsBetween(
                Window.unboundedPreceding, Window.currentRow)))
            .select("id", "p", "h", "salt", "run", "starts", F.sha2(F.col("t").cast("binary"), 256).alias("sha"),
                    F.when(F.col("starts") & (F.col("salt") > 0), F.col("t")).alias("t")))
    in_run = Window.partitionBy("p", "h", "salt", "run")
    runs = store(near.withColumns({"n": F.count("*").over(in_run),
                                   "best": (F.max if keep == "max" else F.min)("id").over(in_run)})
                 .select("id", "h", "p", "salt", "run", "starts", "sha", "t", "n", "best"), "exact-runs")

    of_text = Window.partitionBy("t")
    heads = runs.filter("salt > 0 and starts").select(
        "p", "h", "salt", "run", F.sum("n").over(of_text).alias("total"),
        (F.max if keep == "max" else F.min)("best").over(of_text).alias("keep_id"))
    # ties of a null id: equal ids share a salt, so the best id is in one run only
    whole = runs.filter("salt = 0").select("id", F.col("best").alias("keep_id"), F.col("n").alias("total"),
                                           "starts", "sha")
    split = runs.filter("salt > 0").drop("n", "best", "t").join(heads, ["p", "h", "salt", "run"]).select(
        "id", "keep_id", "total", "starts", "sha")
    rows = whole.unionByName(split)
    return rows.select(F.col("id").alias("doc_id"), "keep_id", F.col("total").cast("long").alias("group_size"),
                       (F.col("starts") & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                       F.col("sha").alias("text_sha256"))


def op13_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="max")
