"""J1 search impressions and J2 search clicks.

Plan shape (both jobs):

* ``filtered_base``: one scan with the row filters; the local-date bound is
  written on the stored timestamp so it reaches the Parquet reader.
* Group facts: per (search_id, session_id, keyword) the distinct SKUs and
  the key/value pivot, from one unnest of a tagged array and one
  aggregation (partial aggregation before the shuffle).
* Screening (valid sessions, excluded sessions, stopwords) depends only on
  session and keyword, both part of the group key, so it runs once per
  group instead of once per impression.
* The wide impression rows are shuffled once, to meet their group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CLICK_KV_COLUMNS, VIEW_KV_COLUMNS, SearchConfig
from ..functions.channels import (app_version, business_channel, local_date,
                                  local_date_at_least, local_datetime, utc_wall_clock)
from ..functions.paths import not_blank, valid_token
from ..operators.membership import null_aware_anti_join, semi_join
from ..operators.nested import kv_value, sorted_distinct_join, valid_kv

GROUP_KEYS = ("search_id", "session_id", "search_internal_keyword")
_ITEM_TYPE = "array<struct<tag:int,key:string,val:string>>"
_SKU, _KV = 0, 1


def _utc(raw: DataFrame) -> Column:
    return utc_wall_clock(F.col("datetime"), raw.schema["datetime"].dataType)


def row_filter(raw: DataFrame, cfg: SearchConfig) -> Column:
    """Local date bound, accounts (case-folded), page types, search id, result count."""
    return (
        local_date_at_least(F.col("datetime"), raw.schema["datetime"].dataType, cfg.date_from, cfg.zone)
        & F.upper(F.col("account_id")).isin(*cfg.accounts)
        & F.col("catalog_page_type").isin(*cfg.page_types)
        & valid_token(F.col("search_id"), cfg.invalid_search_ids)
        & (F.col("search_result_count") > 0)
    )


def screen(groups: DataFrame, searches: DataFrame, members: DataFrame, stopwords: DataFrame,
           cfg: SearchConfig) -> DataFrame:
    """Valid session, not an excluded session, keyword not a stopword (null-aware)."""
    out = semi_join(groups, searches, F.col("session_id"), F.col("session_id"))
    excluded = members.where(F.col("client_status").isin(*cfg.excluded_statuses))
    out = null_aware_anti_join(out, excluded, F.col("session_id"), F.col("session_id"))
    return null_aware_anti_join(
        out, stopwords, F.lower(F.col("search_internal_keyword")), F.lower(F.col("stopword_keyword"))
    )


def _tagged(array: Column, tag: int, key, val) -> Column:
    items = F.transform(array, lambda e: F.struct(F.lit(tag).alias("tag"), key(e).alias("key"),
                                                  val(e).alias("val")))
    return F.coalesce(items, F.array().cast(_ITEM_TYPE))


def group_facts(rows: DataFrame, kv_spec: Sequence[tuple[str, Sequence[str]]],
                sku_list: str | None) -> DataFrame:
    """A5 + A6/A7 in one aggregation per (search_id, session_id, keyword).

    SKUs (non-blank, distinct, sorted, comma-joined; null when none) and the
    key/value columns come from a single unnest of one tagged array, so both
    are computed in one exchange. Groups with a null keyword get null facts,
    as an equi-join on a null key matches nothing.
    """
    parts = []
    if sku_list is not None:
        skus = F.filter(F.col(sku_list), lambda p: not_blank(p["sku"]))
        parts.append(_tagged(skus, _SKU, lambda p: F.lit(None).cast("string"), lambda p: p["sku"]))
    parts.append(_tagged(valid_kv(F.col("extension_data")), _KV, lambda e: e["key"], lambda e: e["val"]))
    items = parts[0] if len(parts) == 1 else F.concat(*parts)
    exploded = rows.select(*GROUP_KEYS, F.explode_outer(items).alias("__it"))
    is_kv = F.col("__it.tag") == F.lit(_KV)
    aggs = []
    if sku_list is not None:
        aggs.append(sorted_distinct_join(
            F.collect_set(F.when(F.col("__it.tag") == F.lit(_SKU), F.col("__it.val")))).alias("skus"))
    aggs += [F.max(F.when(is_kv, kv_value(F.col("__it.key"), F.col("__it.val"), keys))).alias(name)
             for name, keys in kv_spec]
    grouped = exploded.groupBy(*GROUP_KEYS).agg(*aggs)
    has_key = F.col("search_internal_keyword").isNotNull()
    facts = [n for n in grouped.columns if n not in GROUP_KEYS]
    return grouped.select(*GROUP_KEYS, *[F.when(has_key, F.col(n)).alias(n) for n in facts])


def _attach(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Inner join of rows with their (screened) group; null keyword matches null keyword."""
    g = groups.select(*[F.col(k).alias(f"__g_{k}") for k in GROUP_KEYS],
                      *[c for c in groups.columns if c not in GROUP_KEYS])
    cond = ((F.col("search_id") == F.col("__g_search_id"))
            & (F.col("session_id") == F.col("__g_session_id"))
            & F.col("search_internal_keyword").eqNullSafe(F.col("__g_search_internal_keyword")))
    joined = rows.join(g, cond, "inner")
    return joined.select(*rows.columns, *[c for c in groups.columns if c not in GROUP_KEYS])


def _screened_groups(raw, searches, members, stopwords, cfg, kv_spec, sku_list):
    cols = [*GROUP_KEYS, "extension_data"] + ([sku_list] if sku_list else [])
    rows = raw.where(row_filter(raw, cfg)).select(*cols)
    return screen(group_facts(rows, kv_spec, sku_list), searches, members, stopwords, cfg)


def search_views(raw: DataFrame, searches: DataFrame, members: DataFrame, stopwords: DataFrame,
                 cfg: SearchConfig) -> DataFrame:
    """Screened impressions with SKU list and 18 key/value columns (42 columns)."""
    utc = _utc(raw)
    rows = raw.where(row_filter(raw, cfg)).select(
        business_channel(F.col("account_id"), F.col("device_type"), cfg).alias("business_channel"),
        local_date(utc, cfg.zone).alias("date"),
        "search_id", "session_id", "catalog_page_type", "client_member_id",
        "actual_search_internal_keyword", "account_id", "device", "device_type",
        "page_number", "page_url",
        local_datetime(utc, cfg.zone).alias("datetime"),
        "applied_filter", "all_category_click", "sort_by", "search_internal_keyword",
        "browser", "sequence",
        app_version(F.col("account_id"), F.col("app_version"), cfg).alias("app_version"),
        "search_result_count", "search_internal_category_id", "search_internal_category_name",
    )
    groups = _screened_groups(raw, searches, members, stopwords, cfg, VIEW_KV_COLUMNS, "product_list")
    return _attach(rows, groups)


def search_clicks(raw: DataFrame, searches: DataFrame, members: DataFrame, stopwords: DataFrame,
                  cfg: SearchConfig) -> DataFrame:
    """Screened clicks with 15 key/value columns (36 columns)."""
    utc = _utc(raw)
    rows = raw.where(row_filter(raw, cfg)).select(
        business_channel(F.col("account_id"), F.col("device_type"), cfg).alias("business_channel"),
        local_date(utc, cfg.zone).alias("date"),
        local_datetime(utc, cfg.zone).alias("event_datetime"),
        "search_id", "session_id", "catalog_page_type", "actual_search_internal_keyword",
        "page_number", "page_url", "applied_filter", "sort_by", "search_internal_keyword",
        "search_internal_category_id", "search_internal_category_name",
        "product_sku", "click_type", "product_name", "browser", "sequence",
        app_version(F.col("account_id"), F.col("app_version"), cfg).alias("app_version"),
        "search_result_count",
    )
    groups = _screened_groups(raw, searches, members, stopwords, cfg, CLICK_KV_COLUMNS, None)
    return _attach(rows, groups)


def screened_rows(raw: DataFrame, searches: DataFrame, members: DataFrame, stopwords: DataFrame,
                  cfg: SearchConfig) -> DataFrame:
    """The filtered and screened rows themselves (the ``base`` relation), row by row."""
    rows = raw.where(row_filter(raw, cfg))
    return screen(rows, searches, members, stopwords, cfg)


def sku_lists(raw: DataFrame, cfg: SearchConfig) -> DataFrame:
    """N15 + A5 alone: distinct sorted SKUs per group of filtered rows (groups without SKUs absent)."""
    from ..operators.nested import collect_distinct_string
    rows = raw.where(row_filter(raw, cfg)).select(*GROUP_KEYS, "product_list")
    return collect_distinct_string(rows, GROUP_KEYS, "product_list", "sku", "skus")


def kv_columns(raw: DataFrame, cfg: SearchConfig,
               spec: Sequence[tuple[str, Sequence[str]]] = VIEW_KV_COLUMNS) -> DataFrame:
    """N16 + A6/A7 alone: the key/value pivot per group of filtered rows."""
    from ..operators.nested import kv_pivot
    rows = raw.where(row_filter(raw, cfg)).select(*GROUP_KEYS, "extension_data")
    return kv_pivot(rows, GROUP_KEYS, "extension_data", spec)
