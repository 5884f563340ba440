"""J3/J4 traps (T9-T13) and J8 parsing and resume."""

import json
import uuid

import pandas as pd
from pyspark.sql import functions as F

from siftkit.config import FactsConfig
from siftkit.plans import catalog, enrich
from siftkit.sources.tables import materialize
from siftkit.session import ensure_checkpoint_dir

CAT = "id string, parent_category_id string, category_level int, catalog_code string, category_code string, name string, name_english string"


def _category(spark):
    rows = [
        ("r1", None, 1, "main", "A", "Root", "root"),
        ("r2", None, 1, "main", "B", "Lonely", "lonely"),         # no child: vanishes (T10)
        ("r3", None, 1, "other", "Z", "Other", "other"),
        ("n1", "r1", 2, "other", "A2", "Two", None),               # child in another catalog still kept
        ("n2", "n1", 3, "main", "A3", None, "three"),              # name null, code not (T9)
        ("n3", "r3", 2, "main", "Z2", "Z two", "z two"),
    ]
    return spark.createDataFrame(rows, CAT)


def test_category_paths(spark):
    out = catalog.category_paths(_category(spark), "main", levels=4).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.c1_code, r.c2_code, r.c3_code, r.c4_code) == ("A", "A2", "A3", None)
    assert (r.cn_code, r.cn_name, r.cn_name_english) == ("A3", "Two", "three")


def test_map_search_categories(spark):
    cat = _category(spark)
    paths = catalog.category_paths(cat, "main", levels=4)
    views = spark.createDataFrame(
        [("A/A3", ), ("A/X", ), ("X", ), ("", ), (None, ), ("A2", )], "search_internal_category_id string"
    ).withColumn("datetime", F.lit("2025-03-01 10:00:00").cast("timestamp_ntz"))
    cfg = FactsConfig(catalog_code="main", levels=4)
    out = {r.search_internal_category_id: r for r in catalog.map_search_categories(views, cat, paths, cfg).collect()}
    assert set(out) == {"A/A3", "A/X"}                       # T11: unknown-only strings vanish; A2 is 'other'
    assert (out["A/A3"].matched_level, out["A/A3"].c2_name, out["A/A3"].c3_name) == (3, "Two", None)
    assert (out["A/X"].matched_level, out["A/X"].c1_name, out["A/X"].c2_name) == (1, "Root", None)   # T13


def _predict(pdf):
    rows = []
    for t in pdf["search_internal_keyword"]:
        if t == "boom":
            raise RuntimeError("service down")
        if t == "bad":
            rows.append(("{not json", None, None))
        elif t == "slow":
            rows.append((None, "TIMEOUT", "Request timed out after 30s"))
        elif t == "two":
            cats = [{"score": 0.9, "c1CategoryCode": "X1", "c3_name": "first"}, {"score": 0.1, "c3_name": "second"}]
            rows.append((json.dumps({"code": 200, "status": "OK", "data": {"isGenericTerm": False,
                                                                          "categoryHierarchyList": cats}}), None, None))
        elif t == "nodata":
            rows.append((json.dumps({"code": 200, "status": "OK"}), None, None))
        else:
            rows.append((json.dumps({"code": 200, "status": "OK", "data": {"categoryHierarchyList": []}}), None, None))
    return pd.DataFrame(rows, columns=["response", "error_type", "error_message"])


def test_parse_predictions(spark):
    terms = spark.createDataFrame([(t, 0) for t in ["bad", "slow", "two", "nodata", "empty", "", None]],
                                  "search_internal_keyword string, batch_id long")
    out = {r.search_internal_keyword: r for r in enrich.enrich_terms(terms, _predict).collect()}
    assert out["bad"].status == "JSON_ERROR: Invalid JSON response" and out["bad"].code is None
    assert out["slow"].status == "TIMEOUT: Request timed out after 30s"
    assert (out["two"].code, out["two"].c3_name, out["two"].score, out["two"].isGenericTerm) == (200, "first", 0.9, False)
    assert out["nodata"].c3_name is None and out["nodata"].status == "OK"
    assert out[""].status.startswith("SKIP") and out[None].status.startswith("SKIP")
    boom = spark.createDataFrame([("boom", 0)], "search_internal_keyword string, batch_id long")
    assert enrich.enrich_terms(boom, _predict).collect()[0].status == "ERROR: service down"


def test_summary_counts_null_code_as_failure(spark):
    res = spark.createDataFrame([(0, 200), (0, None), (1, 500)], "batch_id long, code int")
    rows = {r.batch_id: r for r in enrich.enrichment_summary(res, 4).collect()}
    assert (rows[0].success, rows[0].failed, rows[1].failed) == (1, 1, 1)
    assert rows[None].success_pct == 25.0 and rows[None].failed_pct == 50.0
    empty = enrich.enrichment_summary(res.limit(0), 0).collect()
    assert empty[0].success_pct is None


def test_resume_writes_every_batch_once(spark):
    terms = spark.createDataFrame([(f"t{i:02d}",) for i in range(23)], "search_internal_keyword string")
    stage = lambda df, n: materialize(df, n)
    batched = stage(enrich.term_batches(terms, stage, enrich.EnrichConfig(batch_size=5)), "tb")
    out_dir = f"{ensure_checkpoint_dir(spark)}/test-enrich-{uuid.uuid4().hex}"
    csv_dir = out_dir + "-csv"
    first = enrich.run_enrichment(batched, _predict, out_dir, fresh=True, batches_per_job=1, max_jobs=2,
                                 csv_checkpoint_dir=csv_dir)
    assert first.batches_written == [0, 1]
    second = enrich.run_enrichment(batched, _predict, out_dir, fresh=False, batches_per_job=1, csv_checkpoint_dir=csv_dir)
    assert second.batches_written == [2, 3, 4]
    again = enrich.run_enrichment(batched, _predict, out_dir, fresh=False)   # nothing left
    assert again.batches_written == []
    res = enrich.read_results(spark, out_dir)
    assert res.count() == 23 and res.select("search_internal_keyword").distinct().count() == 23
    csv = enrich.read_results(spark, csv_dir, fmt="csv")
    assert sorted(map(tuple, csv.collect()), key=repr) == sorted(map(tuple, res.collect()), key=repr)


def test_resume_with_new_terms_keeps_finished_rows(spark):
    kw = "search_internal_keyword"
    stage = lambda df, n: materialize(df, n)
    cfg = enrich.EnrichConfig(batch_size=2)
    out_dir = f"{ensure_checkpoint_dir(spark)}/test-enrich-{uuid.uuid4().hex}"

    def batches(words):
        return stage(enrich.term_batches(spark.createDataFrame([(w,) for w in words], f"{kw} string"), stage, cfg), "tb")

    enrich.run_enrichment(batches("bdfh"), _predict, out_dir, fresh=True)
    before = set(map(tuple, enrich.read_results(spark, out_dir).collect()))
    stats = enrich.run_enrichment(batches("abcdfh"), _predict, out_dir, fresh=False)
    after = list(map(tuple, enrich.read_results(spark, out_dir).collect()))
    assert before <= set(after) and len(after) == 6
    assert sorted(r[kw] for r in enrich.read_results(spark, out_dir).collect()) == list("abcdfh")
    assert stats.terms == 2 and stats.timing()["records_per_sec"] > 0


def test_a_failing_term_does_not_spoil_its_batch():
    import pandas as pd

    def predict(pdf):
        if (pdf["search_internal_keyword"] == "bad").any():
            raise RuntimeError("bad term")
        return pd.DataFrame({"response": pdf["search_internal_keyword"].str.upper()})

    terms = ["a", "bad", "b", None, "", "c"]
    out = enrich._call_predictor(pd.DataFrame({"search_internal_keyword": terms, "batch_id": 0}), predict)
    assert out["response"].tolist() == ["A", None, "B", None, None, "C"]
    assert out["error_type"].tolist() == [None, "ERROR", None, "SKIP", "SKIP", None]


def test_stored_answers_have_all_six_outcomes(spark):
    kw = "search_internal_keyword"
    ok = '{"code": 200, "status": "OK"}'
    answers = spark.createDataFrame(
        [("good", ok, None, None), ("good", '{"code": 500, "status": "later"}', None, None), ("cut", '{"code"', None, None),
         ("none", None, None, None), ("late", None, "TIMEOUT", "Request timed out after 30s"), ("", ok, None, None),
         ("http", ok, "HTTP_ERROR", None), ("dead", None, "ERROR", None), (None, ok, None, None)],
        f"{kw} string, response string, error_type string, error_message string")
    terms = spark.createDataFrame([(t, 3) for t in ["good", "cut", "none", "late", "http", "dead", "away", "", None]],
                                  f"{kw} string, batch_id int")
    got = {r[kw]: (r["code"], r["status"]) for r in enrich.enrich_terms(terms, answers).collect()}
    assert got == {"good": (200, "OK"), "cut": (None, "JSON_ERROR: Invalid JSON response"),
                   "none": (None, "JSON_ERROR: Invalid JSON response"), "late": (None, "TIMEOUT: Request timed out after 30s"),
                   "http": (None, "HTTP_ERROR: "), "dead": (None, "ERROR: "), "away": (None, "CONNECTION_ERROR: Failed to connect to API"),
                   "": (None, "SKIP: Empty or null search term"), None: (None, "SKIP: Empty or null search term")}
    assert enrich.enrich_terms(terms.limit(0), answers).count() == 0
    assert {r["status"].split(":")[0] for r in enrich.enrich_terms(terms, answers.limit(0)).collect()} == {
        "CONNECTION_ERROR", "SKIP"}


def test_one_job_writes_all_batches_and_a_resumed_run_only_the_rest(spark):
    kw = "search_internal_keyword"
    out_dir = f"{ensure_checkpoint_dir(spark)}/test-enrich-{uuid.uuid4().hex}"
    terms = spark.createDataFrame([(f"t{i}", i // 4) for i in range(22)], f"{kw} string, batch_id long")
    answers = terms.select(kw, F.lit('{"code": 200, "status": "OK"}').alias("response"),
                           F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error_message"))
    early = answers.withColumn("response", F.lit('{"code": 200, "status": "EARLY"}'))
    first = enrich.run_enrichment(terms, early, out_dir, batches_per_job=2, max_jobs=1)
    assert (first.jobs, first.batches_written, first.terms) == (1, [0, 1], 8)
    rest = enrich.run_enrichment(terms, answers, out_dir, fresh=False)
    assert (rest.jobs, rest.terms) == (1, 14)
    rows = enrich.read_results(spark, out_dir).collect()
    assert {(r[kw], r["status"]) for r in rows} == {(f"t{i}", "EARLY" if i < 8 else "OK") for i in range(22)}
    assert len(rows) == 22 and enrich.run_enrichment(terms, answers, out_dir, fresh=False).jobs == 0
    none = enrich.run_enrichment(terms.limit(0), answers, out_dir + "-none")
    assert (none.jobs, none.terms, none.timing()["records_per_sec"]) == (0, 0, None)


def test_mapping_in_order(spark):
    rows = spark.createDataFrame([(7, "b"), (2, "a/b"), (1, "é"), (4, "a"), (None, "b"), (9, None)], "n int, search_internal_category_id string")
    out = catalog.mapping_in_order(rows, materialize).collect()
    assert [tuple(r) for r in sorted(out, key=lambda r: r["position"])] == [
        (9, None, 0), (4, "a", 1), (2, "a/b", 2), (None, "b", 3), (7, "b", 4), (1, "é", 5)]
