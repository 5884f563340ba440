"""Corpus pipeline: clean, deduplicate, mask, mix and pack ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns the columns of ``documents``; the last returns packed pieces.
Rows are followed from an operator's result back to their text by id and
text hash, so no row number has to survive a second scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siftkit.llm.common import prepare, row_key, store, table, text_hash
from siftkit.llm.mixing import mix_documents
from siftkit.llm.neardup import near_duplicates
from siftkit.llm.packing import pack_documents
from siftkit.llm.pii import find_pii, mask_all
from siftkit.llm.quality import clean_lines, score_quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__key", row_key(F.col("doc_id"), text_hash(F.col("text"))))


def _columns(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.select(*[F.col(c) for c in like.columns])


def _one_of_each(docs: DataFrame, keep: DataFrame, name: str) -> DataFrame:
    """One row of ``docs`` for each key of ``keep`` (__key, __rows: rows of docs with it, and what else is to be joined).

    Rows equal in id and text stand for each other. Only keys met more than once go
    through a second shuffle to leave one row.
    """
    taken = _keyed(docs).join(store(keep, name), "__key")
    return taken.filter("__rows = 1").unionByName(taken.filter("__rows > 1").dropDuplicates(["__key"]))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the failing lines of the others go too (n_chars follows).

    Null, empty and very short texts are rejected. Repeated rows are judged each for
    itself. Other columns pass through untouched, whatever their names. No rows: no rows.
    """
    prepare(spark)
    # the operator's own columns must not meet those of the documents
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    own = docs.select("text", F.struct(*[F.col(c) for c in rest]).alias("__row"))
    judged = score_quality(own).filter("kept")
    text = F.when(F.col("lost_chars") > 0, clean_lines(F.col("text"))).otherwise(F.col("text"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return judged.select(*[new.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (shingles of five words, 0.8) stays: the one with the smallest id.

    Texts without words are linked with nothing and stay; of rows equal in id and text one stays.
    Null ids: a class of null ids only keeps one row. Other columns pass through. No rows: no rows.
    """
    prepare(spark)
    found = near_duplicates(docs.select("doc_id", "text"), shingle=5)
    keep = (found.select(row_key(F.col("doc_id"), F.col("text_hash")).alias("__key"), "first")
            .groupBy("__key").agg(F.count("*").alias("__rows"), F.max("first").alias("__first")).filter("__first"))
    return _columns(_one_of_each(docs, keep, "pipeline-keep"), docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind (n_chars follows).

    Spans of the fixed patterns are found again where they are masked; only those that the method
    adds are joined. Null texts stay null, empty ones empty. Repeated rows are masked alike. Other columns pass
    through. No rows: no rows.
    """
    prepare(spark)
    spans = find_pii(docs.select("doc_id", "text")).filter(F.size("found") > 0).select(
        row_key(F.col("doc_id"), F.col("text_hash")).alias("__key"),
        F.col("found").alias("__found")).dropDuplicates(["__key"])  # equal texts have equal spans
    hit = _keyed(docs).join(store(spans, "pipeline-spans"), "__key", "left")
    text = F.pandas_udf(mask_all, StringType())(F.col("text"), F.col("__found"))
    return _columns(hit.withColumn("text", text).withColumn("n_chars", F.coalesce(F.length("text").cast("long"),
                                                                                  F.col("n_chars"))), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents by the mix: a source's words come within half a document of what it is allotted.

    Null and empty texts have no words and are not taken. Rows equal in id and text share what they are
    allotted. A null source is a source of its own, last. Other columns pass through. No rows: no rows.
    """
    prepare(spark)
    mixed = mix_documents(docs.select("doc_id", "text", "source"))
    plan = (mixed.select(row_key(F.col("doc_id"), F.col("text_hash")).alias("__key"), "copies").groupBy("__key")
            .agg(F.count("*").alias("__rows"), F.sum("copies").cast("int").alias("__copies")).filter("__copies > 0"))
    taken = _one_of_each(docs, plan, "pipeline-mix")
    return _columns(taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens.

    Null and empty texts are one token, the end mark; repeated rows are packed each for itself. Other columns
    are left behind. No rows: no rows.
    """
    prepare(spark)
    return pack_documents(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing), ("packing", packing)]

# The tokenizer and the swap search have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store(docs, f"pipeline-{name}")
    return docs
