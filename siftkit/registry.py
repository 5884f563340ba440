"""Named queries over the adapter tables: the driver contract and the benchmark.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Upstream job
outputs that other jobs read (search views and clicks, category paths,
exact intent) are written once per data directory to the shared checkpoint
folder, as the warehouse tables they stand for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import apply_plan_settings, ship_package
from .sources.fixtures import FACTS_CFG, SEARCH_CFG, Fixtures
from .sources.tables import materialize


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.fx = Fixtures(spark, sf_dir)
        self._stored: dict[str, DataFrame] = {}

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._stored:
            self._stored[name] = materialize(build(), name)
        return self._stored[name]

    # job outputs read by later jobs
    def views(self) -> DataFrame:
        return self.stored("search_views", lambda: search_views_q(self))

    def clicks(self) -> DataFrame:
        return self.stored("search_clicks", lambda: search_clicks_q(self))

    def paths(self) -> DataFrame:
        return self.stored("category_paths", lambda: category_paths_q(self))

    def exact(self) -> DataFrame:
        return self.stored("keyword_intent_exact", lambda: keyword_intent_exact_q(self))


_CONTEXTS: dict[tuple[str, str], Context] = {}


def context(spark: SparkSession, sf_dir: str) -> Context:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CONTEXTS:
        apply_plan_settings(spark)
        ship_package(spark)
        _CONTEXTS[key] = Context(spark, sf_dir.rstrip("/"))
    return _CONTEXTS[key]


# ---------------------------------------------------------------- J1, J2
from .plans import search as _search  # noqa: E402


def search_views_q(c: Context) -> DataFrame:
    fx = c.fx
    return _search.search_views(fx["fx_view"], fx["fx_sessions"], fx["fx_members"], fx["fx_stopwords"], SEARCH_CFG)


def search_clicks_q(c: Context) -> DataFrame:
    fx = c.fx
    return _search.search_clicks(fx["fx_click"], fx["fx_sessions"], fx["fx_members"], fx["fx_stopwords"], SEARCH_CFG)


def screened_sessions_q(c: Context) -> DataFrame:
    fx = c.fx
    from .operators.membership import null_aware_anti_join, semi_join
    rows = fx["fx_view"].select("search_id", "session_id", "search_internal_keyword", "datetime")
    rows = semi_join(rows, fx["fx_sessions"], F.col("session_id"), F.col("session_id"))
    excluded = fx["fx_members"].where(F.col("client_status").isin(*SEARCH_CFG.excluded_statuses))
    return null_aware_anti_join(rows, excluded, F.col("session_id"), F.col("session_id"))


def screened_sessions_null_set_q(c: Context) -> DataFrame:
    fx = c.fx
    from .operators.membership import null_aware_anti_join
    rows = fx["fx_view"].select("search_id", "session_id", "search_internal_keyword", "datetime")
    excluded = fx["fx_members_with_null"].where(F.col("client_status").isin(*SEARCH_CFG.excluded_statuses))
    return null_aware_anti_join(rows, excluded, F.col("session_id"), F.col("session_id"))


def screened_sessions_empty_set_q(c: Context) -> DataFrame:
    """Nothing is excluded, so every row stays, those with a null session too."""
    fx = c.fx
    from .operators.membership import null_aware_anti_join
    rows = fx["fx_view"].select("search_id", "session_id", "search_internal_keyword", "datetime")
    excluded = fx["fx_members_with_null"].where(F.col("client_status") == "")
    return null_aware_anti_join(rows, excluded, F.col("session_id"), F.col("session_id"))


def stopword_screen_q(c: Context) -> DataFrame:
    fx = c.fx
    from .operators.membership import null_aware_anti_join
    rows = fx["fx_view"].select("search_id", "session_id", "search_internal_keyword", "datetime")
    return null_aware_anti_join(rows, fx["fx_stopwords"], F.lower(F.col("search_internal_keyword")),
                                F.lower(F.col("stopword_keyword")))


def sku_lists_q(c: Context) -> DataFrame:
    return _search.sku_lists(c.fx["fx_view"], SEARCH_CFG)


def kv_pivot_q(c: Context) -> DataFrame:
    return _search.kv_columns(c.fx["fx_view"], SEARCH_CFG)


def business_channel_q(c: Context) -> DataFrame:
    from .functions.channels import app_version, business_channel
    v = c.fx["fx_view"]
    return v.select(
        "search_id", "session_id", "datetime", "account_id", "device_type",
        business_channel(F.col("account_id"), F.col("device_type"), SEARCH_CFG).alias("business_channel"),
        app_version(F.col("account_id"), F.col("app_version"), SEARCH_CFG).alias("app_version"),
    )


QUERIES: dict[str, Callable[[Context], DataFrame]] = {
    "search_views": search_views_q,
    "search_clicks": search_clicks_q,
    "screened_sessions": screened_sessions_q,
    "screened_sessions_null_set": screened_sessions_null_set_q,
    "screened_sessions_empty_set": screened_sessions_empty_set_q,
    "stopword_screen": stopword_screen_q,
    "sku_lists": sku_lists_q,
    "kv_pivot": kv_pivot_q,
    "business_channel": business_channel_q,
}


# ---------------------------------------------------------------- J3, J4
from .plans import catalog as _catalog  # noqa: E402
from .plans import facts as _facts  # noqa: E402


def category_paths_q(c: Context) -> DataFrame:
    return _catalog.category_paths(c.fx["fx_category"], FACTS_CFG.catalog_code, FACTS_CFG.levels)


def category_paths_any_depth_q(c: Context) -> DataFrame:
    """Paths of any depth by their links, cycles marked."""
    return _catalog.category_paths_any_depth(c.fx["fx_category"], FACTS_CFG.catalog_code, materialize)


def counted_frame_q(c: Context) -> DataFrame:
    """A query's result as a frame together with its row count, by one job."""
    from .sources.tables import materialize_counted
    views = c.views().groupBy("date", "business_channel").agg(F.count_distinct("session_id").alias("sessions"))
    frame, rows = materialize_counted(views, "views-by-channel")
    return frame.withColumn("rows", F.lit(rows))


def category_mapping_q(c: Context) -> DataFrame:
    return _catalog.map_search_categories(c.views(), c.fx["fx_category"], c.paths(), FACTS_CFG)


def mapping_in_order_q(c: Context) -> DataFrame:
    return _catalog.mapping_in_order(category_mapping_q(c), materialize)


def path_explode_q(c: Context) -> DataFrame:
    return _catalog.exploded_paths(c.views(), FACTS_CFG)


def deepest_category_q(c: Context) -> DataFrame:
    return _catalog.deepest_known_code(_catalog.exploded_paths(c.views(), FACTS_CFG), c.fx["fx_category"], FACTS_CFG)


# ---------------------------------------------------------------- J5
def keyword_facts_q(c: Context) -> DataFrame:
    return _facts.keyword_facts(c.views(), c.clicks(), c.fx["fx_kw_category"], c.paths(), FACTS_CFG, materialize)


def _counted(c: Context) -> DataFrame:
    return _facts.distinct_counts(_facts.loads_base(c.views(), FACTS_CFG).select("session_id", _facts.KW),
                                  _facts.clicks_base(c.clicks(), FACTS_CFG).select("session_id", _facts.KW))


def keyword_loads_clicks_q(c: Context) -> DataFrame:
    return _facts.keyword_counts(_counted(c))


def funnel_totals_q(c: Context) -> DataFrame:
    return _facts.funnel_totals(_counted(c))


def keyword_category_any_q(c: Context) -> DataFrame:
    return _facts.keyword_category(c.fx["fx_kw_category"])


def category_fill_in_q(c: Context) -> DataFrame:
    return _facts.fill_category(_facts.loads_base(c.views(), FACTS_CFG),
                                _facts.keyword_category(c.fx["fx_kw_category"]))


QUERIES.update({
    "category_paths": category_paths_q,
    "category_paths_any_depth": category_paths_any_depth_q,
    "counted_frame": counted_frame_q,
    "category_mapping": category_mapping_q,
    "mapping_in_order": mapping_in_order_q,
    "path_explode": path_explode_q,
    "deepest_category": deepest_category_q,
    "keyword_facts": keyword_facts_q,
    "keyword_loads_clicks": keyword_loads_clicks_q,
    "funnel_totals": funnel_totals_q,
    "keyword_category_any": keyword_category_any_q,
    "category_fill_in": category_fill_in_q,
})


# ---------------------------------------------------------------- J6, J7
from .functions.text import norm_str  # noqa: E402
from .plans import intent as _intent  # noqa: E402


def _stage(df: DataFrame, name: str) -> DataFrame:
    return materialize(df, name)


def normalized_text_q(c: Context) -> DataFrame:
    docs = c.fx["documents"]
    return docs.select("doc_id", norm_str(F.col("text")).alias("normalized_text"))


def ner_flat_q(c: Context) -> DataFrame:
    return _intent.ner_flat(c.fx["fx_ner"])


def ner_exact_q(c: Context) -> DataFrame:
    base = _intent.base_keywords(c.fx["fx_keywords"])
    return base.select(_intent.KW).join(_intent.ner_exact(base, _intent.ner_flat(c.fx["fx_ner"])), _intent.KW, "left")


def dictionary_exact_match_q(c: Context) -> DataFrame:
    fx = c.fx
    base = _intent.base_keywords(fx["fx_keywords"])
    specs = [
        ("brand", _intent.brand_names(fx["fx_brand"]), "brand_name"),
        ("product_type", _intent.product_type_values(fx["fx_attributes"]), "attribute_value"),
        ("seller", _intent.exact_sellers(fx["fx_seller"]), "business_partner_name"),
    ]
    parts = []
    for tag, values, raw in specs:
        d = _intent.dictionary(values, raw, "raw", "norm")
        m = _intent.exact_match(base, d, "norm", "raw", "matched", "matched_raw")
        parts.append(m.select(_intent.KW, F.lit(tag).alias("dictionary"), "matched_raw"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def keyword_intent_exact_q(c: Context) -> DataFrame:
    fx = c.fx
    return _intent.keyword_intent_exact(fx["fx_keywords"], fx["fx_ner"], fx["fx_brand"], fx["fx_attributes"],
                                        fx["fx_seller"], stage=_stage)


def _fuzzy_dict_q(kind: str, flag: str, out: str):
    def q(c: Context) -> DataFrame:
        fx = c.fx
        queries = _intent.fuzzy_queries(c.exact()).where(~F.col(flag))
        dicts = _intent.fuzzy_dictionaries(fx["fx_brand"], fx["fx_attributes"], fx["fx_seller"])
        return _intent.fuzzy_dictionary_match(queries, dicts[kind], out)
    return q


def fuzzy_ner_match_q(c: Context) -> DataFrame:
    queries = _intent.fuzzy_queries(c.exact())
    nv = _intent.ner_norm(c.fx["fx_ner"])
    b = _intent.fuzzy_ner_match(queries.where(~F.col("is_brand_exact")), nv, "brand", "matched_ner_value")
    p = _intent.fuzzy_ner_match(queries.where(~F.col("is_product_type_exact")), nv, "product_type",
                                "matched_ner_value")
    return (b.select(_intent.KW, F.lit("brand").alias("attribute_name"), "matched_ner_value")
            .unionByName(p.select(_intent.KW, F.lit("product_type").alias("attribute_name"), "matched_ner_value")))


def fuzzy_match_reference_norm_q(c: Context) -> DataFrame:
    from .functions.text import first_char
    d = _intent.fuzzy_dictionaries(c.fx["fx_brand"], c.fx["fx_attributes"], c.fx["fx_seller"],
                                   distinct=False)["brand"]
    return d.select("value", F.length("value").cast("long").alias("len"), first_char(F.col("value")).alias("fc"))


def fuzzy_match_norm_str_q(c: Context) -> DataFrame:
    """The dictionaries under the keywords' own normaliser, and how many keywords equal a value of theirs then."""
    fx = c.fx
    d = _intent.tagged_dictionary(fx["fx_brand"], fx["fx_attributes"], fx["fx_seller"], normalizer="norm_str")
    typed = _intent.base_keywords(fx["fx_keywords"]).groupBy(F.col("normalized_keyword").alias("value")).agg(
        F.count(F.lit(1)).alias("keywords"))
    return d.join(typed, "value", "left").select("dictionary", "value", F.coalesce("keywords", F.lit(0)).alias("keywords"))


def keyword_intent_fuzzy_q(c: Context) -> DataFrame:
    fx = c.fx
    return _intent.keyword_intent_fuzzy(c.exact(), fx["fx_ner"], fx["fx_brand"], fx["fx_attributes"], fx["fx_seller"],
                                        stage=_stage)


QUERIES.update({
    "normalized_text": normalized_text_q,
    "ner_flat": ner_flat_q,
    "ner_exact": ner_exact_q,
    "dictionary_exact_match": dictionary_exact_match_q,
    "keyword_intent_exact": keyword_intent_exact_q,
    "fuzzy_brand_match": _fuzzy_dict_q("brand", "is_brand_exact", "matched_brand_master"),
    "fuzzy_product_type_match": _fuzzy_dict_q("product_type", "is_product_type_exact", "matched_product_type_master"),
    "fuzzy_seller_match": _fuzzy_dict_q("seller", "is_seller_exact", "matched_seller"),
    "fuzzy_ner_match": fuzzy_ner_match_q,
    "fuzzy_match_reference_norm": fuzzy_match_reference_norm_q,
    "fuzzy_match_norm_str": fuzzy_match_norm_str_q,
    "keyword_intent_fuzzy": keyword_intent_fuzzy_q,
})


# ---------------------------------------------------------------- J8
from .plans import enrich as _enrich  # noqa: E402
from .session import ensure_checkpoint_dir  # noqa: E402
from .sources.fixtures import ENRICH_CFG  # noqa: E402


def _fresh(c: Context, name: str) -> str:
    import uuid
    return f"{ensure_checkpoint_dir(c.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _pending(c: Context) -> DataFrame:
    return _enrich.pending_terms(c.views(), c.fx["fx_status_v1"], c.fx["fx_status_v2"], ENRICH_CFG)


def pending_terms_q(c: Context) -> DataFrame:
    return _pending(c)


def term_batches_q(c: Context) -> DataFrame:
    return _enrich.term_batches(_pending(c), _stage, ENRICH_CFG)


def _batched(c: Context) -> DataFrame:
    return _enrich.term_batches(_pending(c), _stage, ENRICH_CFG)


def enrich_terms_q(c: Context) -> DataFrame:
    return _enrich.enrich_terms(_batched(c), c.fx["fx_responses"])


def parse_predictions_q(c: Context) -> DataFrame:
    """The pending terms of the screened views, batched, answered and parsed."""
    return enrich_terms_q(c).drop("batch_id")


def parse_stored_answers_q(c: Context) -> DataFrame:
    """E4/X22/X23 over every stored answer, asked for or not."""
    return _enrich.parse_predictions(c.fx["fx_responses"].withColumn("batch_id", F.lit(None).cast("long"))).drop("batch_id")


def prediction_outcomes_q(c: Context) -> DataFrame:
    """The outcome of every keyword and category string that was searched, null and empty ones included."""
    v = c.fx.view("fx_view")
    terms = v.select(_enrich.KW).unionByName(v.select(F.col("search_internal_category_id").alias(_enrich.KW))).distinct()
    raw = _enrich.stored_answers(terms.withColumn("batch_id", F.lit(0)), c.fx["fx_responses"])
    return _enrich.parse_predictions(raw).select(_enrich.KW, "code", "status")


def enrichment_summary_q(c: Context) -> DataFrame:
    batched = _stage(_batched(c), "term_batches")
    results = _enrich.enrich_terms(batched, c.fx["fx_responses"])
    total = batched.select(F.count(F.lit(1))).scalar()
    return _enrich.enrichment_summary(results, total, ENRICH_CFG.success_code)


def run_statistics_q(c: Context) -> DataFrame:
    """A written run's statistics: counts of each batch and in all, terms, jobs, and whether it was timed."""
    batched = _stage(_batched(c), "term_batches")
    out_dir = _fresh(c, "enrichment")
    stats = _enrich.run_enrichment(batched, c.fx["fx_responses"], out_dir)
    t = stats.timing()
    timed = bool(t["records_per_sec"]) and abs(t["hours"] * 3600 + t["minutes"] * 60 + t["seconds"] - stats.seconds) < 0.01
    summary = _enrich.enrichment_summary(_enrich.read_results(c.spark, out_dir), stats.terms, ENRICH_CFG.success_code)
    return summary.withColumns({"terms": F.lit(stats.terms).cast("long"), "jobs": F.lit(stats.jobs).cast("long"),
                                "timed": F.lit(timed)})


def batch_resume_q(c: Context) -> DataFrame:
    """A run is interrupted after two batches and resumed when the service answers otherwise: finished rows stay."""
    batched = _stage(_batched(c), "term_batches")
    answers, out_dir = c.fx["fx_responses"], _fresh(c, "enrichment")
    early = answers.withColumn("response", F.replace("response", F.lit('"OK"'), F.lit('"EARLY"')))
    _enrich.run_enrichment(batched, early, out_dir, fresh=True, batches_per_job=1, max_jobs=2)
    _enrich.run_enrichment(batched, answers, out_dir, fresh=False)
    return _enrich.read_results(c.spark, out_dir)


QUERIES.update({
    "pending_terms": pending_terms_q,
    "term_batches": term_batches_q,
    "enrich_terms": enrich_terms_q,
    "parse_predictions": parse_predictions_q,
    "parse_stored_answers": parse_stored_answers_q,
    "enrichment_summary": enrichment_summary_q,
    "batch_resume": batch_resume_q,
    "prediction_outcomes": prediction_outcomes_q,
    "run_statistics": run_statistics_q,
})


# ---------------------------------------------------------------- tables: replace, append, ledger, CSV, buckets
from .sources import ledger as _ledger  # noqa: E402
from .sources.fixtures import REPLACED_BEFORE, csv_terms_sql, nfkc_terms_sql  # noqa: E402
from .sources.tables import write_colocated  # noqa: E402


def table_replace_append_q(c: Context) -> DataFrame:
    """Job output created, replaced and appended by date; a second append of the same dates is refused."""
    rows = c.views().select(F.to_date("datetime").alias("day"), "search_id", "session_id", _facts.KW)
    early, late = rows.where(F.col("day") < REPLACED_BEFORE), rows.where(F.col("day") >= REPLACED_BEFORE)
    t = _ledger.BatchTable(c.spark, _fresh(c, "views-by-day"), rows.schema, "day")
    t.replace(rows.withColumn("search_id", F.lit("outdated")), "created")
    t.replace(early, "replaced")
    t.append(late, "appended")
    try:
        t.append(late, "again")
        refused = False
    except _ledger.BatchLoaded:
        refused = True
    t.resume(rows, "resumed")                                    # nothing is missing
    return t.read().groupBy("day", "load").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("session_id").alias("sessions"),
        F.count_if(F.col("search_id") == "outdated").alias("outdated")).withColumn("refused", F.lit(refused))


def ledger_resume_q(c: Context) -> DataFrame:
    """A run that dies between data and commit of its second batch, then more terms and a resumed run."""
    results = _stage(enrich_terms_q(c), "enriched")
    t = _ledger.BatchTable(c.spark, _fresh(c, "enrichment"), results.schema, "batch_id")
    first = results.where("batch_id <= 1")
    t.commit(t.write(first, "first"), "first", batches=first.where("batch_id = 0"))
    t.resume(results, "second")
    return t.read()


def csv_round_trip_q(c: Context) -> DataFrame:
    """Hostile terms through CSV: those that fit come back equal, the others are marked as rejected."""
    path = _fresh(c, "terms-csv")
    _ledger.write_csv(c.spark.sql(csv_terms_sql(), part=c.fx["part"]), path)
    back = _ledger.read_csv(c.spark, path, _ledger.StructType().add("id", "long").add("term", "string").add("size", "integer"))
    return back.select("id", "term", "size", F.col("rejected").isNotNull().alias("rejected"))


def colocated_loads_clicks_q(c: Context) -> DataFrame:
    """J1/J2/J5 on storage partitioned by date and bucketed by session and keyword."""
    import uuid
    tables = [write_colocated(_facts.session_keywords(df, at), f"siftkit_{name}_{uuid.uuid4().hex}", _fresh(c, name), "day",
                              ["session_id", _facts.KW], 16)
              for name, df, at in (("loads", c.views(), "datetime"), ("clicks", c.clicks(), "event_datetime"))]
    return _facts.loads_with_clicks(*tables, FACTS_CFG)


def nfkc_terms_q(c: Context) -> DataFrame:
    """Terms that NFKC changes, normalised through a stored side table."""
    from .functions.text import latin_form, nfkc_lookup, norm_dict, with_nfkc
    terms = c.spark.sql(nfkc_terms_sql(), part=c.fx["part"])
    lookup = _stage(nfkc_lookup(terms, "term"), "nfkc")
    out = with_nfkc(terms, "term", lookup, "form")
    return out.select("id", "term", "form", latin_form(F.lower("form")).alias("normalized"),
                      norm_dict(F.col("term")).alias("dictionary_form"))


QUERIES.update({
    "nfkc_terms": nfkc_terms_q,
    "table_replace_append": table_replace_append_q,
    "ledger_resume": ledger_resume_q,
    "csv_round_trip": csv_round_trip_q,
    "colocated_loads_clicks": colocated_loads_clicks_q,
})


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, _f=fn: _f(context(spark, sf_dir))) for name, fn in QUERIES.items()}
