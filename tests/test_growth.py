"""Queries that did less than their job, and work that stayed in one task or was made for no reader."""

import glob
import re

import __spark_entry__ as E
from pyspark.sql import functions as F

from siftkit.plans import enrich
from siftkit.registry import Context
from siftkit.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


def test_parse_predictions_runs_the_whole_chain(spark):
    """the pending terms of the screened views are answered, not only the stored answers parsed."""
    got = E.queries()["parse_predictions"](spark, SF)
    want = E.queries()["enrich_terms"](spark, SF).drop("batch_id")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "fx_status_v1" in E.oracle_sql()["parse_predictions"]


def test_batches_are_written_by_many_tasks_each_by_one(spark):
    """few bytes in many batches were put into one writing task."""
    batched = spark.range(400).select(F.concat(F.lit("t"), F.col("id")).alias(enrich.KW), (F.col("id") % 40).alias("batch_id"))
    answers = batched.select(enrich.KW, F.lit('{"code": 200}').alias("response"), F.lit(None).cast("string").alias("error_type"),
                             F.lit(None).cast("string").alias("error_message"))
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/growth-batches".replace("file:", "")
    enrich.run_enrichment(batched, answers, out)
    files = glob.glob(f"{out}/batch_id=*/*.parquet")
    assert len(files) == 40
    assert len({re.search(r"part-(\d+)", f).group(1) for f in files}) > 1
    assert enrich.read_results(spark, out).count() == 400


def test_outcomes_make_no_product_lists(spark):
    """the terms are read from the views without storing their product lists."""
    from siftkit.registry import prediction_outcomes_q
    c = Context(spark, SF)
    assert prediction_outcomes_q(c).count() > 0
    assert "fx_view" not in c.fx._frames
