"""J5 keyword facts: loads with category fill-in, clicks, per-keyword and global counts.

Plan notes:

* Per-keyword distinct-session counts and the global totals are taken from
  the date-filtered loads before the category fill-in. The fill-in is a
  left join with at most one row per keyword and the DISTINCT does not
  change distinct counts, so the counts are the same while the scan reads
  only session and keyword columns.
* All distinct counts come from one table: a row of loads or clicks is
  expanded into its grouping sets, one distinct shares the exchange, and a
  second small aggregation counts. Loads and clicks are scanned once each
  for all counts.
* Global totals are one-row scalar subqueries instead of cross joins.
* The closing DISTINCT of the studied SQL is implied: the loads are
  distinct, the click join matches at most one row (clicks are distinct on
  all three join keys), the keyword counts have one row per keyword, and
  the sales categories are made distinct on exactly the columns kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FactsConfig
from ..functions.channels import date_between
from ..functions.paths import path_part

KW = "search_internal_keyword"
LOAD_COLS = ("date", "session_id", "search_id", KW, "catalog_page_type", "account_id", "device_type",
             "device", "app_version", "search_result_count", "business_channel", "result_type",
             "is_spellcheck_result", "search_keyword_type", "search_internal_category_id")
FILL_COLS = ("c1_code", "c2_code", "c3_code", "ds_category_ids")
SALES_NAMES = ("c1_name", "c2_name", "c3_name", "c1_name_english", "c2_name_english", "c3_name_english")


def loads_base(views: DataFrame, cfg: FactsConfig) -> DataFrame:
    """Impressions in the window with lower-cased keyword and codes split from ``ds_category_ids``."""
    ds = F.col("ds_category_ids")
    return views.where(date_between(F.col("datetime"), cfg.date_from, cfg.date_to)).select(
        F.to_date("datetime").alias("date"), "session_id", "search_id", F.lower(F.col(KW)).alias(KW),
        *LOAD_COLS[4:], "ds_category_ids",
        path_part(ds, 0).alias("c1_code"), path_part(ds, 1).alias("c2_code"), path_part(ds, 2).alias("c3_code"),
    )


def keyword_category(kw_map: DataFrame) -> DataFrame:
    """One category per lower-cased keyword; ANY_VALUE taken as the per-column minimum."""
    return (kw_map.where(F.col("c1CategoryCode").isNotNull())
            .groupBy(F.lower(F.col(KW)).alias(KW))
            .agg(F.min("c1CategoryCode").alias("c1_code"), F.min("c2CategoryCode").alias("c2_code"),
                 F.min("c3CategoryCode").alias("c3_code"), F.min("c3_category").alias("ds_category_ids")))


def fill_category(base: DataFrame, kw_category: DataFrame) -> DataFrame:
    """N7 + X18 + A1: each level and the path filled from the keyword table when missing; distinct."""
    k = kw_category.select(KW, *[F.col(c).alias(f"__k_{c}") for c in FILL_COLS])
    joined = base.join(k, KW, "left")
    return joined.select(
        *LOAD_COLS, *[F.coalesce(F.col(c), F.col(f"__k_{c}")).alias(c) for c in FILL_COLS]
    ).distinct()


def clicks_base(clicks: DataFrame, cfg: FactsConfig) -> DataFrame:
    """Distinct (session, search, lower keyword) clicks in the window."""
    return (clicks.where(date_between(F.col("event_datetime"), cfg.date_from, cfg.date_to))
            .select("session_id", "search_id", F.lower(F.col(KW)).alias(KW)).distinct())


_BY_KEYWORD, _PAIRS = 0, 1


def distinct_counts(base: DataFrame, clicks: DataFrame) -> DataFrame:
    """A2-A4 in one pass: distinct counts of loads and clicks, per keyword and over all.

    Every (session, keyword) becomes one row of each grouping set: the
    session under its keyword, and the pair (CONCAT without separator) under
    one of ``_SPREAD`` salts, so that no task counts all pairs. One distinct
    on all columns serves both sets.

    Returns is_load, set, key (keyword or null), salt, n: rows to be summed by :func:`keyword_counts`
    and :func:`funnel_totals`.
    """
    def expanded(df: DataFrame, is_load: bool) -> DataFrame:
        pair = F.concat(F.col("session_id"), F.col(KW))
        none = F.lit(None).cast("string")
        sets = F.array(
            F.struct(F.lit(_BY_KEYWORD).alias("set"), F.col(KW).alias("key"), F.lit(0).cast("long").alias("salt"),
                     F.col("session_id").alias("value")),
            F.struct(F.lit(_PAIRS).alias("set"), none.alias("key"),
                     F.pmod(F.xxhash64(pair), F.lit(_SPREAD)).alias("salt"), pair.alias("value")))
        return df.select(F.lit(is_load).alias("is_load"), F.inline(sets))
    every = expanded(base, True).unionByName(expanded(clicks, False)).distinct()
    return every.groupBy("is_load", "set", "key", "salt").agg(F.count("value").alias("n"))


_SPREAD = 64            # salts of the pairs


def keyword_counts(counted: DataFrame) -> DataFrame:
    """A2: distinct sessions per keyword for loads and clicks (null clicks when never clicked), of :func:`distinct_counts`."""
    by_keyword = counted.where(F.col("set") == _BY_KEYWORD)
    both = by_keyword.groupBy(F.col("key").alias(KW)).agg(
        F.max(F.when(F.col("is_load"), F.col("n"))).alias("search_loads"),
        F.max(F.when(~F.col("is_load") & F.col("key").isNotNull(), F.col("n"))).alias("search_clicks"))
    return both.where(F.col("search_loads").isNotNull())


def funnel_totals(counted: DataFrame) -> DataFrame:
    """A3/A4: distinct (session, keyword) pairs of loads and of clicks and distinct keywords of loads, as one row."""
    pairs = F.col("set") == _PAIRS
    return counted.agg(
        F.coalesce(F.sum(F.when(pairs & F.col("is_load"), F.col("n"))), F.lit(0)).alias("total_loads"),
        F.coalesce(F.sum(F.when(pairs & ~F.col("is_load"), F.col("n"))), F.lit(0)).alias("total_clicks"),
        F.count(F.when(~pairs & F.col("is_load"), F.col("key"))).alias("total_keywords"))


def sales_categories(paths: DataFrame) -> DataFrame:
    """Level 1-3 names per level-3 code, distinct on the columns the facts keep."""
    return paths.select("c3_code", *SALES_NAMES).distinct()


def keyword_facts(views: DataFrame, clicks: DataFrame, kw_map: DataFrame, paths: DataFrame,
                  cfg: FactsConfig = FactsConfig(), stage=None) -> DataFrame:
    """One row per distinct filled load, with click match, counts, names and totals (32 columns).

    ``stage`` writes the counts (one row per keyword, side and salt) to a table; without it their plan is
    repeated for the counts and for each total.
    """
    base = loads_base(views, cfg)
    loads = fill_category(base, keyword_category(kw_map))
    cb = clicks_base(clicks, cfg)
    counted = distinct_counts(base.select("session_id", KW), cb.select("session_id", KW))
    if stage is not None:
        counted = stage(counted, "keyword_counts")
    counts = keyword_counts(counted)
    totals = {c: funnel_totals(counted).select(c).scalar() for c in ("total_loads", "total_clicks", "total_keywords")}
    cbm = cb.select(F.col("session_id").alias("__cb_s"), F.col("search_id").alias("__cb_q"),
                    F.col(KW).alias("__cb_k"))
    out = loads.join(cbm, (F.col("session_id") == F.col("__cb_s")) & (F.col("search_id") == F.col("__cb_q"))
                     & (F.col(KW) == F.col("__cb_k")), "left")
    out = out.join(counts, KW, "left")
    sc = sales_categories(paths).withColumnRenamed("c3_code", "__sc_c3")
    out = out.join(sc, F.col("c3_code") == F.col("__sc_c3"), "left")
    return out.select(
        *LOAD_COLS, *FILL_COLS,
        F.col("session_id").alias("loads_session_id"),
        F.col("__cb_s").alias("clicks_session_id"),
        "search_loads", "search_clicks", *SALES_NAMES,
        totals["total_loads"].alias("total_loads"),
        totals["total_clicks"].alias("total_clicks"),
        totals["total_keywords"].alias("total_keywords"),
    )


def session_keywords(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """(day, session_id, keyword) of search events, keyword in lower case: what co-located tables hold."""
    return df.select(F.to_date(time_col).alias("day"), "session_id", F.lower(F.col(KW)).alias(KW)).distinct()


def loads_with_clicks(loads: DataFrame, clicks: DataFrame, cfg: FactsConfig) -> DataFrame:
    """Per keyword the sessions that loaded it and those of them that clicked, from tables of :func:`session_keywords`.

    Over tables bucketed by session and keyword neither the distinct nor the join shuffles, and the
    date window prunes partitions; only one partial count per keyword and task is shuffled.
    """
    window = F.col("day").between(F.lit(cfg.date_from), F.lit(cfg.date_to))
    keys = ["session_id", KW]
    a = loads.where(window).groupBy(*keys).agg(F.lit(1).alias("loaded"))
    b = clicks.where(window).groupBy(*keys).agg(F.lit(1).alias("clicked"))
    return a.join(b.hint("merge"), keys, "left").groupBy(KW).agg(F.count("loaded").alias("sessions_loaded"),
                                                   F.count("clicked").alias("sessions_clicked"))
