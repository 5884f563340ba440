"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import ensure_checkpoint_dir, ship_package

# Words of every contract: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to Python workers and keep Arrow batches small enough for long texts."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > 512:
        spark.conf.set(key, "512")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_hash(text: Column) -> Column:
    """With the id a key of a row's text (null as empty) that any scan can compute again."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.octet_length(F.coalesce(text, F.lit(""))))


def row_key(doc_id: Column, hashed: Column) -> Column:
    """One join key of id and text hash; null ids are equal."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), hashed.cast("string"))


COLLECT_EVERY = 8        # stored tables between two requests to free what no plan can read any more
_stored = 0


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts the lineage).

    Spark removes the shuffle files of finished plans only when the driver collects
    garbage, which a driver with little to hold may not do for hours. Iterative operators
    would pile them up, so the driver is asked to now and then.
    """
    global _stored
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    _stored += 1
    if _stored % COLLECT_EVERY == 0:
        spark.sparkContext._jvm.System.gc()
    return out


def discard(*stored: DataFrame) -> None:
    """Remove tables of :func:`store` that no later step reads."""
    for df in stored:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def global_order(df: DataFrame, order: Sequence[str], sums: Sequence[str], name: str) -> DataFrame:
    """Number all rows in a global order and add exclusive prefix sums, without a single-task window.

    Returns a stored table with the columns of ``df`` plus ``idx`` (0-based
    place in the order of ``order``) and ``before_<c>`` for each column c of
    ``sums`` (the sum of c over all earlier rows; c must not be null). Rows
    equal in ``order`` are told apart by their place in the stored input,
    so a key that holds many rows is still spread over range partitions.
    Three steps: range-partition and sort; running totals inside each
    partition; per-partition totals (one row per partition, so their
    broadcast is bounded by the partition count) shift the running totals.
    """
    base = store(df.withColumn("__tie", F.monotonically_increasing_id()), f"{name}-in")
    cols = [*order, "__tie"]
    ranged = (base.repartitionByRange(*[F.col(c).asc_nulls_last() for c in cols])
              .sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in cols])
              .withColumn("__part", F.spark_partition_id()))
    schema = StructType([*ranged.schema.fields, StructField("idx", LongType()),
                         *[StructField(f"before_{c}", LongType()) for c in sums]])
    sums = list(sums)

    def running(batches):
        seen, acc = 0, dict.fromkeys(sums, 0)
        for pdf in batches:
            pdf["idx"] = range(seen, seen + len(pdf))
            seen += len(pdf)
            for c in sums:
                run = pdf[c].astype("int64").cumsum()
                pdf[f"before_{c}"] = run - pdf[c] + acc[c]
                acc[c] += int(run.iloc[-1]) if len(run) else 0
            yield pdf

    local = store(ranged.mapInPandas(running, schema), f"{name}-local")
    parts = local.groupBy("__part").agg(F.count("*").alias("__n"), *[F.sum(c).alias(f"__s_{c}") for c in sums])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__o"),
                         *[F.coalesce(F.sum(f"__s_{c}").over(earlier), F.lit(0)).alias(f"__o_{c}") for c in sums])
    return (local.join(F.broadcast(shift), "__part")
            .withColumn("idx", F.col("idx") + F.col("__o"))
            .withColumns({f"before_{c}": F.col(f"before_{c}") + F.col(f"__o_{c}") for c in sums})
            .drop("__part", "__tie", "__o", *[f"__o_{c}" for c in sums]))


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph given as longs (a, b): rows (node, root).

    Alternates large-star and small-star steps until the edge set is a set of
    stars around each component's smallest node. Only nodes with an edge to
    another node are returned (the root itself included). Minima are
    pre-aggregated before each shuffle; every round is stored, so lineage
    stays short and a lost executor costs one round at most.
    """
    e = store(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
              .filter("hi != lo").distinct(), f"{name}-edges")
    state = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
        both = e.select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionByName(
            e.select(F.col("lo").alias("a"), F.col("hi").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.filter("b > a").join(low, "a")
                 .select(F.col("b").alias("hi"), F.col("m").alias("lo")).filter("hi != lo").distinct())
        low2 = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(low2, "hi")
                 .select(F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                                           F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")))).alias("e"))
                 .select("e.hi", "e.lo").filter("hi != lo").distinct())
        e, last = store(small, f"{name}-round"), e
        discard(last)
    else:
        raise RuntimeError("components did not settle")
    leaf = e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    out = store(leaf.unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("root"))).distinct(),
                f"{name}-roots")
    discard(e)
    return out
