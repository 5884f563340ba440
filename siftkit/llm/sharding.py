"""Operator 1: contiguous shards of near-equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import global_order, prepare, table


def shard_by_bytes(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut the rows, in the order of their id, into ``n_shards`` runs of near-equal bytes.

    A row's size is the UTF-8 bytes of its text (null: none) plus 1. With S
    the sum of all sizes, the row whose middle byte lies in the k-th of
    ``n_shards`` equal parts of S goes to shard k, so each shard's bytes
    differ from S / n_shards by at most the largest row. Only
    (id, size, checksum) is shuffled, never the text.

    Null text: size 1, checksum that of the empty text. Null ids sort last.
    Rows equal in id and text take neighbouring slots in any order (they
    give equal output rows but for the slot). Very long texts count whole.
    No rows: no rows. Extra columns are ignored.

    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot (place in
    the shard, from 0), grown_shard (null: this law has none).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    placed = global_order(narrow, ["doc_id", "text_crc32", "size"], ["size"], "shards")
    total = placed.agg(F.sum("size")).first()[0] or 1
    cut = placed.withColumn("shard", F.expr(
        f"cast(least({n_shards - 1}, ((2 * before_size + size) * {n_shards}L) div {2 * total}L) as int)"))
    starts = cut.groupBy("shard").agg(F.min("idx").alias("first_idx"))  # at most n_shards rows
    return (cut.join(F.broadcast(starts), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("idx") - F.col("first_idx")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def op1_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return shard_by_bytes(table(spark, sf_dir, "documents"))
