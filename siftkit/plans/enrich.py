"""J8 category enrichment of keywords that lack a category.

Answers come from one of two places, given as ``answers``:

- a DataFrame of stored answers (``search_internal_keyword``, ``response``,
  ``error_type``, ``error_message``), joined to the terms;
- a function ``predict_fn(pdf) -> pdf`` of the caller's: given a pandas frame
  with ``search_internal_keyword`` it returns, per row and in order,
  ``response`` (raw JSON text or None), ``error_type`` (None or one of
  TIMEOUT, CONNECTION_ERROR, HTTP_ERROR, ERROR) and ``error_message``. It
  owns the transport (HTTP session, retries, timeouts). Spark runs it in
  parallel tasks (``mapInPandas``).

Everything else - choosing pending terms, batching, parsing, classifying,
writing, resuming and the statistics - is DataFrame work.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from ..config import CONNECTION_MESSAGE, JSON_MESSAGE, SKIP_MESSAGE, EnrichConfig
from ..functions.paths import is_missing, null_or_empty
from ..operators.batching import Stage, assign_batches
from ..operators.membership import in_either
from ..sources.tables import materialize, read_partitions, write_partitions

KW = "search_internal_keyword"

RAW_SCHEMA = StructType([
    StructField(KW, StringType()),
    StructField("batch_id", LongType()),
    StructField("response", StringType()),
    StructField("error_type", StringType()),
    StructField("error_message", StringType()),
])

RESULT_FIELDS = [
    StructField(KW, StringType()),
    StructField("code", IntegerType()),
    StructField("status", StringType()),
    StructField("isGenericTerm", BooleanType()),
    StructField("isValidC3", BooleanType()),
    StructField("score", DoubleType()),
    StructField("c1CategoryCode", StringType()),
    StructField("c2CategoryCode", StringType()),
    StructField("c3CategoryCode", StringType()),
    StructField("c3_name", StringType()),
    StructField("c3_category", StringType()),
]
RESULT_SCHEMA = StructType(RESULT_FIELDS + [StructField("batch_id", LongType())])

Predictor = Callable[[pd.DataFrame], pd.DataFrame]
Answers = DataFrame | Predictor


def pending_terms(views: DataFrame, status_v1: DataFrame, status_v2: DataFrame,
                  cfg: EnrichConfig = EnrichConfig()) -> DataFrame:
    """Distinct keywords without a category whose earlier status was not OK in either run."""
    missing = views.where(is_missing(F.col("ds_category_ids"), cfg.sentinels)).select(KW)
    not_ok = lambda s: s.where(F.lower(F.col("status")) != F.lit(cfg.ok_status))
    return in_either(missing, not_ok(status_v2), not_ok(status_v1), F.col(KW), F.col(KW), F.col(KW)).distinct()


def term_batches(terms: DataFrame, stage: Stage, cfg: EnrichConfig = EnrichConfig(),
                 method: str = "ordered") -> DataFrame:
    """P16 + E2: non-null distinct terms in batches of ``cfg.batch_size``."""
    unique = terms.select(KW).where(F.col(KW).isNotNull()).distinct()
    return assign_batches(unique, KW, cfg.batch_size, stage, method)


def _call_predictor(pdf: pd.DataFrame, predict_fn: Predictor) -> pd.DataFrame:
    out = pd.DataFrame({KW: pdf[KW], "batch_id": pdf["batch_id"], "response": None,
                        "error_type": None, "error_message": None}, index=pdf.index)
    terms = pdf[KW]
    skip = terms.isna() | (terms == "")
    out.loc[skip, "error_type"] = "SKIP"
    out.loc[skip, "error_message"] = SKIP_MESSAGE
    todo = [pdf.index[~skip]]
    while todo:   # a failing call is repeated in halves, so only the terms at fault become ERROR rows
        part = todo.pop()
        if not len(part):
            continue
        try:
            res = predict_fn(pdf.loc[part, [KW]].reset_index(drop=True))
            res.index = part
        except Exception as exc:  # noqa: BLE001 - any predictor failure becomes an ERROR row
            if len(part) > 1:
                half = len(part) // 2
                todo += [part[half:], part[:half]]
            else:
                out.loc[part, "error_type"] = "ERROR"
                out.loc[part, "error_message"] = str(exc)
            continue
        for col in ("response", "error_type", "error_message"):
            if col in res:
                out.loc[part, col] = res[col].astype(object).where(res[col].notna(), None)
    return out


def run_predictor(batched: DataFrame, predict_fn: Predictor, partitions: int | None = None) -> DataFrame:
    """One predictor call per term, spread over ``partitions`` tasks."""
    rows = batched.select(KW, F.col("batch_id").cast("long").alias("batch_id"))
    if partitions:
        rows = rows.repartition(partitions)

    def apply(batches):
        for pdf in batches:
            yield _call_predictor(pdf, predict_fn)

    return rows.mapInPandas(apply, RAW_SCHEMA)


def stored_answers(batched: DataFrame, answers: DataFrame) -> DataFrame:
    """E3/E5 from a table of answers: one join on the term, so its tasks follow the size of the data.

    Null and empty terms are skipped (X24), whatever the table holds for them, and their key is null, so they
    meet no row and are no hot key. A term without an answer was never reached: CONNECTION_ERROR. Of
    several answers to a term the smallest counts.
    """
    fields = ("response", "error_type", "error_message")
    known = (answers.where(~null_or_empty(F.col(KW))).groupBy(F.col(KW).alias("__term"))
             .agg(F.min(F.struct(*fields)).alias("__answer")))
    rows = batched.select(KW, F.col("batch_id").cast("long").alias("batch_id"))
    skip = null_or_empty(F.col(KW))
    met = rows.join(known, F.when(~skip, F.col(KW)) == F.col("__term"), "left")
    lost = F.col("__answer").isNull()
    return met.select(
        KW, "batch_id", F.when(~skip, F.col("__answer.response")).alias("response"),
        F.when(skip, "SKIP").when(lost, "CONNECTION_ERROR").otherwise(F.col("__answer.error_type")).alias("error_type"),
        F.when(skip, SKIP_MESSAGE).when(lost, CONNECTION_MESSAGE).otherwise(F.col("__answer.error_message"))
         .alias("error_message"))


def parse_predictions(raw: DataFrame) -> DataFrame:
    """Classify each call and flatten the first category of a valid response.

    A response that is not JSON becomes JSON_ERROR; error rows keep the term,
    a null code and ``"<TYPE>: <message>"`` as status.
    """
    v = F.try_parse_json(F.col("response"))
    err_type = F.coalesce(F.col("error_type"), F.when(v.isNull(), F.lit("JSON_ERROR")))
    err_msg = F.coalesce(F.col("error_message"), F.when(F.col("error_type").isNull(), F.lit(JSON_MESSAGE)))
    ok = F.col("error_type").isNull() & v.isNotNull()

    def get(path: str, dtype: str):
        return F.when(ok, F.try_variant_get(v, path, dtype))

    first = "$.data.categoryHierarchyList[0]"
    return raw.select(
        KW,
        get("$.code", "int").alias("code"),
        F.when(ok, F.try_variant_get(v, "$.status", "string"))
         .otherwise(F.concat(err_type, F.lit(": "), F.coalesce(err_msg, F.lit("")))).alias("status"),
        get("$.data.isGenericTerm", "boolean").alias("isGenericTerm"),
        get("$.data.isValidC3", "boolean").alias("isValidC3"),
        get(f"{first}.score", "double").alias("score"),
        get(f"{first}.c1CategoryCode", "string").alias("c1CategoryCode"),
        get(f"{first}.c2CategoryCode", "string").alias("c2CategoryCode"),
        get(f"{first}.c3CategoryCode", "string").alias("c3CategoryCode"),
        get(f"{first}.c3_name", "string").alias("c3_name"),
        get(f"{first}.c3_category", "string").alias("c3_category"),
        "batch_id",
    )


def enrich_terms(batched: DataFrame, answers: Answers, partitions: int | None = None) -> DataFrame:
    """J8 core: answer and parse (lazy; nothing is written). ``partitions`` spreads the calls of a predictor."""
    if isinstance(answers, DataFrame):
        return parse_predictions(stored_answers(batched, answers))
    return parse_predictions(run_predictor(batched, answers, partitions))


def batch_summary(results: DataFrame, success_code: int = 200) -> DataFrame:
    """Rows, successes and failures per batch (a null code is a failure)."""
    ok = F.col("code") == F.lit(success_code)
    return results.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(ok).alias("success"),
        F.count_if(~F.col("code").eqNullSafe(F.lit(success_code))).alias("failed"),
    )


def enrichment_summary(results: DataFrame, total_terms, success_code: int = 200) -> DataFrame:
    """Per-batch counts plus a totals row (``batch_id`` null) with percentages of all terms.

    ``total_terms`` is a Column (e.g. a scalar subquery) or a number; an
    empty run gives null percentages instead of a division error.
    """
    per_batch = batch_summary(results, success_code)
    totals = per_batch.agg(F.lit(None).cast("long").alias("batch_id"),
                           F.sum("records").alias("records"), F.sum("success").alias("success"),
                           F.sum("failed").alias("failed"))
    both = per_batch.unionByName(totals)
    denom = F.nullif(F.lit(total_terms) if not hasattr(total_terms, "alias") else total_terms, F.lit(0))
    return both.select(
        "batch_id", "records", "success", "failed",
        (F.lit(100.0) * F.col("success") / denom).alias("success_pct"),
        (F.lit(100.0) * F.col("failed") / denom).alias("failed_pct"),
    )


@dataclass
class RunStats:
    jobs: int = 0
    batches_written: list = field(default_factory=list)   # only where the caller bounds the batches of a job
    seconds: float = 0.0
    terms: int = 0

    def timing(self) -> dict:
        h, rem = divmod(self.seconds, 3600)
        m, s = divmod(rem, 60)
        rate = (self.terms / self.seconds) if self.terms and self.seconds else None
        return {"hours": int(h), "minutes": int(m), "seconds": round(s, 2), "records_per_sec": rate}


def finished_terms(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The terms already in the output; None only where there is no output yet."""
    try:
        return read_partitions(spark, out_dir, RESULT_SCHEMA).select(KW)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_enrichment(batched: DataFrame, answers: Answers, out_dir: str, fresh: bool = True,
                   batches_per_job: int | None = None, max_jobs: int | None = None,
                   partitions: int | None = None, csv_checkpoint_dir: str | None = None) -> RunStats:
    """Answer the batches into ``out_dir``, partitioned by ``batch_id``.

    All unfinished batches are written by one job; with ``batches_per_job`` by jobs
    over so many batch numbers each, so that an interrupted run keeps what its finished jobs
    wrote (``max_jobs`` stops early, as an interruption would). A fresh run truncates
    the output with its first job; every other job appends, so earlier rows
    stay whatever number new terms give a batch. A resumed run
    (``fresh=False``) takes the set of finished terms once, as a stored snapshot,
    and skips them. The driver sees the first and last number and the count of the
    terms, and for each job with ``batches_per_job`` the numbers written. With
    ``csv_checkpoint_dir`` the rows of each job are also copied, from the written
    table, to header CSV partitions (S6); no answer is asked for again.
    """
    spark = batched.sparkSession
    start = time.time()
    todo = batched
    done = None if fresh else finished_terms(spark, out_dir)
    if done is not None:
        done = materialize(done.distinct(), "enrich-done")   # later writes do not change it
        todo = batched.join(done, KW, "left_anti")
    todo = materialize(todo, "enrich-todo")
    first, last, n = todo.agg(F.min("batch_id"), F.max("batch_id"), F.count(F.lit(1))).first()
    step = batches_per_job or (last - first + 1 if n else 1)
    stats = RunStats()
    for at in range(first, last + 1, step) if n else ():
        if max_jobs is not None and stats.jobs >= max_jobs:
            break
        terms = todo.where(F.col("batch_id").between(at, at + step - 1))
        replace_all = fresh and stats.jobs == 0
        # a batch is a folder: each is written by one task, and the folders are dealt to all tasks, however small they are
        tasks = min(step, int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
        results = enrich_terms(terms, answers, partitions).repartition(tasks, "batch_id")
        write_partitions(results, out_dir, "batch_id", replace_all=replace_all)
        if csv_checkpoint_dir:
            written = read_results(spark, out_dir).where(F.col("batch_id").between(at, at + step - 1)).join(
                terms.select(KW), KW, "left_semi")
            write_partitions(written, csv_checkpoint_dir, "batch_id", replace_all=replace_all, fmt="csv")
        stats.jobs += 1
        if batches_per_job:
            stats.batches_written += sorted(r["batch_id"] for r in terms.select("batch_id").distinct().collect())
            stats.terms += terms.count()
        else:
            stats.terms = n
    stats.seconds = time.time() - start
    return stats


def read_results(spark: SparkSession, out_dir: str, fmt: str = "parquet") -> DataFrame:
    """The enrichment output (or its CSV checkpoint) read back with the explicit schema."""
    return read_partitions(spark, out_dir, RESULT_SCHEMA, fmt=fmt)
