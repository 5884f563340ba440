"""Reading and writing tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """A Parquet table as a relation; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Create-or-replace (``overwrite``) or append a Parquet table."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor recomputes from the table, not
    from the sources) and, unlike ``DataFrame.checkpoint``, the read-back is
    a Parquet scan with column pruning and filter pushdown.
    """
    base = ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """A query's result as a stored frame with its row count, both from the one job that writes it.

    The count is an observed metric at the top of the plan, taken in the
    writing tasks; a partition that is computed again counts once.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    stored = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return stored, int(seen.get["rows"])


def write_colocated(df: DataFrame, name: str, path: str, partition_col: str, keys: list[str], buckets: int) -> DataFrame:
    """A table partitioned by ``partition_col`` and bucketed by ``keys``, for joins and aggregates on ``keys`` without a shuffle.

    Rows are dealt to their buckets before the write, so every partition holds one file a bucket. Bucket
    numbers follow all keys; two tables with equal keys and ``buckets`` join in place.
    """
    (df.repartition(buckets, *keys).write.mode("overwrite").partitionBy(partition_col).bucketBy(buckets, *keys)
     .sortBy(*keys).option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def write_partitions(df: DataFrame, path: str, partition_col: str, replace_all: bool,
                     fmt: str = "parquet", header: bool = True) -> None:
    """Batch-partitioned output.

    ``replace_all`` truncates the table (first batch of a fresh run),
    whatever overwrite mode the session has; otherwise rows are appended and
    earlier rows, also those of the same partition, stay.
    """
    writer = df.write.partitionBy(partition_col)
    if replace_all:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        writer = writer.mode("append")
    if fmt == "csv":
        writer.option("header", header).csv(path)
    else:
        writer.parquet(path)


def read_partitions(spark: SparkSession, path: str, schema: StructType,
                    fmt: str = "parquet", header: bool = True) -> DataFrame:
    """Read a batch-partitioned output back with an explicit schema."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", header).csv(path)
    return reader.parquet(path)
