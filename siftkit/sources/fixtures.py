"""Adapter tables over the provided test data.

The jobs read search events, sessions, a category tree, dictionaries and so
on; the test data holds TPC-H-like tables and an event stream. Each adapter
below derives one job input from those tables with a single SQL text. The
text is rendered for Spark (tables passed as DataFrame parameters) or for
DuckDB (tables and other adapters referenced by name), so both engines see
identical inputs. Only array/struct constructors differ between dialects.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..config import EnrichConfig, FactsConfig, SearchConfig
from .tables import read_table

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "lineitem", "events")

# Settings the adapters are built for (fixed test parameters).
SEARCH_CFG = SearchConfig(
    date_from=_dt.date(2024, 1, 5),
    zone="+07:00",
    accounts=("WEB", "ANDROID", "IOS"),
    web_account="WEB",
)
FACTS_CFG = FactsConfig(date_from=_dt.date(2024, 1, 5), date_to=_dt.date(2024, 1, 27), catalog_code="main")
ENRICH_CFG = EnrichConfig(batch_size=16)
ZONE_OFFSET_HOURS = 7


def _struct(d: str, **fields: str) -> str:
    if d == "spark":
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"
    return "struct_pack(" + ", ".join(f"{k} := {v}" for k, v in fields.items()) + ")"


def _array(d: str, *items: str) -> str:
    return ("array(" if d == "spark" else "list_value(") + ", ".join(items) + ")"


def _empty(d: str, spark_type: str, duck_type: str) -> str:
    return f"CAST(array() AS {spark_type})" if d == "spark" else f"CAST([] AS {duck_type})"


def _collect(d: str, expr: str) -> str:
    return f"collect_list({expr})" if d == "spark" else f"list({expr})"


_S = "CAST(NULL AS STRING)"
# what shoppers type for a part: as many keywords as parts
_KEYWORD = "p_name || ' ' || CAST(p_partkey AS STRING)"
# parts are dealt over all suppliers (keys 0 to count - 1)
_SUPPLIER_OF_PART = "p_partkey % (SELECT count(*) FROM {supplier})"
_SUPPLIER_OF_PART_TEXT = f"CAST({_SUPPLIER_OF_PART} AS STRING)"


def _base(d: str) -> str:
    r = "CAST(n.n_regionkey AS STRING)"
    nn = "CAST(n.n_nationkey AS STRING)"
    ss = "CAST(s.s_suppkey AS STRING)"
    leaf = "CAST(p.p_partkey AS STRING)"
    return f"""
SELECT
  e.event_id, e.event_type, e.ts AS datetime,
  CASE WHEN e.event_id % 43 = 0 THEN 'PARTNER'
       WHEN e.user_id % 5 IN (0, 1) THEN 'WEB'
       WHEN e.user_id % 5 = 2 THEN 'ANDROID'
       WHEN e.user_id % 5 = 3 THEN 'IOS'
       ELSE 'web' END AS account_id,
  CASE e.event_id % 5 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'TABLET' WHEN 2 THEN 'DESKTOP'
       WHEN 3 THEN 'N/A' ELSE {_S} END AS device_type,
  CASE e.user_id % 3 WHEN 0 THEN 'phone' WHEN 1 THEN 'tablet' ELSE 'desktop' END AS device,
  CASE WHEN e.event_id % 29 = 0 THEN {_S}
       ELSE 's' || CAST(e.user_id AS STRING) || '-' || CAST(CAST(e.ts AS DATE) AS STRING) END AS session_id,
  CASE WHEN e.event_id % 31 = 0 THEN {_S} WHEN e.event_id % 37 = 0 THEN ''
       WHEN e.event_id % 41 = 0 THEN 'undefined' ELSE 'q' || CAST(e.user_id AS STRING) END AS search_id,
  CASE WHEN e.event_id % 7 = 0 THEN 'home' WHEN e.event_id % 3 = 0 THEN 'search'
       WHEN e.event_id % 3 = 1 THEN 'searchpage' ELSE 'n-1 page' END AS catalog_page_type,
  CASE WHEN e.user_id % 6 = 0 THEN {_S} ELSE 'm' || CAST(e.user_id AS STRING) END AS client_member_id,
  {_KEYWORD} AS actual_search_internal_keyword,
  CAST(e.event_id % 4 + 1 AS INT) AS page_number,
  '/search?q=' || replace({_KEYWORD}, ' ', '+') AS page_url,
  CASE WHEN e.event_id % 9 = 0 THEN 'brand:' || p.p_brand ELSE {_S} END AS applied_filter,
  CASE WHEN e.event_id % 11 = 0 THEN 'true' ELSE 'false' END AS all_category_click,
  CASE e.event_id % 3 WHEN 0 THEN 'relevance' WHEN 1 THEN 'price_asc' ELSE 'newest' END AS sort_by,
  CASE WHEN e.event_id % 53 = 0 THEN {_S} WHEN e.event_id % 2 = 0 THEN upper({_KEYWORD})
       ELSE {_KEYWORD} END AS search_internal_keyword,
  CASE e.user_id % 3 WHEN 0 THEN 'chrome' WHEN 1 THEN 'safari' ELSE 'firefox' END AS browser,
  CAST(e.event_id % 50 AS INT) AS sequence,
  CAST(floor(e.value) AS INT) - 5 AS search_result_count,
  CASE WHEN e.event_id % 13 = 0 THEN 'CX-' || CAST(e.event_id % 5 AS STRING)
       WHEN e.event_id % 17 = 0 THEN {_S}
       WHEN e.event_id % 19 = 0 THEN ''
       WHEN e.event_id % 4 = 0 THEN 'C1-' || {r}
       WHEN e.event_id % 4 = 1 THEN 'C1-' || {r} || '/C2-' || {nn}
       WHEN e.event_id % 4 = 2 THEN 'C1-' || {r} || '/C2-' || {nn} || '/C3-' || {ss}
            || CASE WHEN e.event_id % 3 = 0 THEN '/C4-' || {leaf} ELSE '' END
       WHEN e.event_id % 8 = 3 THEN 'C1-' || {r} || '/CX-1'
       ELSE 'C2-' || {nn} || '/C2-' || CAST((n.n_nationkey + 1) % 25 AS STRING) END
    AS search_internal_category_id,
  n.n_name AS search_internal_category_name,
  CASE e.user_id % 4 WHEN 0 THEN '5.1.0' WHEN 1 THEN '5.2.0' WHEN 2 THEN '6.0.1' ELSE {_S} END AS app_version,
  CASE e.event_id % 6 WHEN 0 THEN {_S} WHEN 1 THEN 'na' WHEN 2 THEN 'n/a'
       WHEN 3 THEN 'C1-' || {r}
       WHEN 4 THEN 'C1-' || {r} || '/C2-' || {nn}
       ELSE 'C1-' || {r} || '/C2-' || {nn} || '/C3-' || {ss} || '/C4-' || {leaf} END AS ds_value,
  regexp_extract(e.props, '[0-9]+', 0) AS props_k,
  p.p_partkey, p.p_name
FROM {{events}} e
JOIN (SELECT l_orderkey, min(l_partkey) AS partkey, min(l_suppkey) AS suppkey FROM {{lineitem}} GROUP BY l_orderkey) o
  ON o.l_orderkey = CASE WHEN e.event_id % 4 = 0 THEN e.event_id ELSE e.user_id * 7 + e.event_id % 3 END
JOIN {{part}} p ON p.p_partkey = o.partkey
JOIN {{supplier}} s ON s.s_suppkey = o.suppkey
JOIN {{nation}} n ON n.n_nationkey = s.s_nationkey
"""


_COMMON_COLS = """b.search_id, b.session_id, b.catalog_page_type, b.actual_search_internal_keyword,
  b.page_number, b.page_url, b.applied_filter, b.sort_by, b.search_internal_keyword, b.browser,
  b.sequence, b.search_result_count, b.search_internal_category_id, b.search_internal_category_name,
  b.account_id, b.device_type, b.app_version, b.datetime"""


def _extension(d: str) -> str:
    kv = lambda k, v: _struct(d, key=k, val=v)
    items = _array(
        d,
        kv("'search_keyword_type'", "b.props_k"),
        kv("CASE WHEN b.event_id % 2 = 0 THEN 'algo' ELSE 'algo_name' END",
           "'algo-' || CAST(b.event_id % 3 AS STRING)"),
        kv("'is_ner_applied'", "CASE WHEN b.event_id % 3 = 0 THEN '' ELSE 'true' END"),
        kv("'ds_category_ids'", "b.ds_value"),
        kv("CASE WHEN b.event_id % 4 = 0 THEN 'search_keyword_type' ELSE 'source' END",
           "CASE WHEN b.event_id % 4 = 0 THEN 'suggest' ELSE 'organic' END"),
        kv("'result_type'", "CASE WHEN b.search_result_count > 20 THEN 'many' ELSE 'few' END"),
        kv("'discount'", "CAST(b.event_id % 5 * 10 AS STRING)"),
    )
    empty = _empty(d, "ARRAY<STRUCT<key: STRING, val: STRING>>", "STRUCT(key VARCHAR, val VARCHAR)[]")
    return (f"CASE WHEN b.event_id % 47 = 0 THEN NULL WHEN b.event_id % 47 = 1 THEN {empty} "
            f"ELSE {items} END")


def _view(d: str) -> str:
    sku = ("CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 6 THEN CAST(NULL AS STRING) "
           "ELSE 'SKU-' || CAST(l_partkey AS STRING) END")
    empty = _empty(d, "ARRAY<STRUCT<sku: STRING>>", "STRUCT(sku VARCHAR)[]")
    # lists only of orders that a view shows: the same rows, without the lists that the join would drop
    shown = " WHERE l_orderkey IN (SELECT event_id FROM {fx_base} WHERE event_type = 'view')" if d == "spark" else ""
    return f"""
SELECT {_COMMON_COLS}, b.device, b.client_member_id, b.all_category_click,
  CASE WHEN b.event_id % 23 = 0 THEN NULL WHEN b.event_id % 23 = 1 THEN {empty}
       ELSE pl.product_list END AS product_list,
  {_extension(d)} AS extension_data
FROM {{fx_base}} b
LEFT JOIN (
  SELECT l_orderkey, {_collect(d, _struct(d, sku=sku))} AS product_list
  FROM {{lineitem}}{shown} GROUP BY l_orderkey
) pl ON pl.l_orderkey = b.event_id
WHERE b.event_type = 'view'
"""


def _click(d: str) -> str:
    return f"""
SELECT {_COMMON_COLS},
  'SKU-' || CAST(b.p_partkey AS STRING) AS product_sku,
  CASE WHEN b.event_id % 2 = 0 THEN 'product' ELSE 'ad' END AS click_type,
  b.p_name AS product_name,
  {_extension(d)} AS extension_data
FROM {{fx_base}} b
WHERE b.event_type = 'click'
"""


def _sessions(d: str) -> str:
    return "SELECT session_id FROM {fx_base} WHERE event_type IN ('signup', 'purchase')"


def _members(d: str, keep_null: bool = False) -> str:
    where = "" if keep_null else " AND session_id IS NOT NULL"
    return ("SELECT session_id, CASE event_id % 3 WHEN 0 THEN 'INTERNAL' WHEN 1 THEN 'GOOGLE_BOT' "
            f"ELSE 'MEMBER' END AS client_status FROM {{fx_base}} WHERE event_type = 'error'{where}")


def _stopwords(d: str) -> str:
    return f"SELECT upper({_KEYWORD}) AS stopword_keyword FROM {{part}} WHERE p_partkey % 41 = 3"


def _category(d: str) -> str:
    def node(level, key, parent, catalog, name, name_en, table, where=""):
        return (f"SELECT 'N{level}-' || CAST({key} AS STRING) AS id, {parent} AS parent_category_id, "
                f"{level} AS category_level, {catalog} AS catalog_code, "
                f"'C{level}-' || CAST({key} AS STRING) AS category_code, {name} AS name, "
                f"{name_en} AS name_english FROM {table}{where}")
    parts = [
        node(1, "r_regionkey", _S, "CASE WHEN r_regionkey = 4 THEN 'other' ELSE 'main' END", "r_name",
             f"CASE WHEN r_regionkey % 4 = 0 THEN {_S} ELSE lower(r_name) END", "{region}"),
        node(1, "c_mktsegment", _S, "'main'", "c_mktsegment", "lower(c_mktsegment)",
             "(SELECT DISTINCT c_mktsegment FROM {customer}) c"),
        node(2, "n_nationkey", "'N1-' || CAST(n_regionkey AS STRING)",
             "CASE WHEN n_nationkey % 7 = 6 THEN 'other' ELSE 'main' END", "n_name",
             f"CASE WHEN n_nationkey % 4 = 0 THEN {_S} ELSE lower(n_name) END", "{nation}"),
        node(3, "s_suppkey", "'N2-' || CAST(s_nationkey AS STRING)", "'main'",
             f"CASE WHEN s_suppkey % 7 = 3 THEN {_S} ELSE s_name END",
             f"CASE WHEN s_suppkey % 4 = 0 THEN {_S} ELSE lower(s_name) END", "{supplier}"),
        # the same level-3 code under a second parent
        "SELECT 'N3b-' || CAST(s_suppkey AS STRING), 'N2-' || CAST((s_nationkey + 1) % 25 AS STRING), 3, "
        "'main', 'C3-' || CAST(s_suppkey AS STRING), s_name, lower(s_name) FROM {supplier} "
        "WHERE s_suppkey % 9 = 0",
        node(4, "p_partkey", f"'N3-' || CAST({_SUPPLIER_OF_PART} AS STRING)", "'main'", "p_name",
             f"CASE WHEN p_partkey % 4 = 0 THEN {_S} ELSE upper(p_name) END", "{part}"),
    ]
    # deeper levels thin out by key parity: a part at level L also has a node at L+1 when
    # its key is divisible by 2^(L-3), so every 16th part reaches level 8
    for level in (5, 6, 7, 8):
        parts.append(node(level, "p_partkey", f"'N{level - 1}-' || CAST(p_partkey AS STRING)", "'main'",
                          "p_brand", "lower(p_brand)", "{part}", f" WHERE p_partkey % {2 ** (level - 4)} = 0"))
    return "\nUNION ALL\n".join(parts)


def _kw_category(d: str) -> str:
    return f"""
SELECT CASE WHEN p_partkey % 3 = 0 THEN upper({_KEYWORD}) ELSE {_KEYWORD} END AS search_internal_keyword,
  CASE WHEN p_partkey % 2 = 1 THEN {_S} ELSE 'C1-' || CAST(p_partkey % 5 AS STRING) END AS c1CategoryCode,
  'C2-' || CAST(p_partkey % 25 AS STRING) AS c2CategoryCode,
  'C3-' || CAST({_SUPPLIER_OF_PART} AS STRING) AS c3CategoryCode,
  'C1-' || CAST(p_partkey % 5 AS STRING) || '/C2-' || CAST(p_partkey % 25 AS STRING)
    || '/C3-' || CAST({_SUPPLIER_OF_PART} AS STRING) AS c3_category
FROM {{part}}
"""


def _keywords(d: str) -> str:
    return """
SELECT DISTINCT kw AS search_internal_keyword FROM (
  SELECT p_name AS kw FROM {part}
  UNION ALL SELECT substr(p_name, 1, 2) || substr(p_name, 4) FROM {part} WHERE p_partkey % 3 = 0
  UNION ALL SELECT p_name || 'x' FROM {part} WHERE p_partkey % 5 = 0
  UNION ALL SELECT lower(p_type) FROM {part}
  UNION ALL SELECT lower(replace(p_brand, '#', ' ')) FROM {part}
  UNION ALL SELECT lower(replace(s_name, '#', ' ')) FROM {supplier}
  UNION ALL SELECT substr(lower(replace(s_name, '#', ' ')), 1, 9) || substr(s_name, 12) FROM {supplier}
    WHERE s_suppkey % 4 = 1
) k
"""


def _ner(d: str) -> str:
    a = lambda *x: _array(d, *x)
    attrs = _array(
        d,
        _struct(d, attribute_name="'brand'", attribute_values=(
            f"CASE WHEN p_partkey % 2 = 0 THEN {a('p_brand', 'p_name')} ELSE {a('p_brand')} END")),
        _struct(d, attribute_name="'product_type'", attribute_values=a("lower(p_type)", "p_name || 's'")),
        _struct(d, attribute_name="'color'", attribute_values=a("split_part(p_name, ' ', 1)")),
    )
    return f"""
SELECT CASE WHEN p_partkey % 3 = 0 THEN substr(p_name, 1, 2) || substr(p_name, 4) ELSE p_name END
    AS search_internal_keyword,
  {attrs} AS attributes
FROM {{part}}
"""


def _brand(d: str) -> str:
    return f"""
SELECT p_brand AS brand_name,
  CASE WHEN p_partkey % 13 = 0 THEN CAST(NULL AS BOOLEAN) ELSE p_partkey % 7 = 0 END AS mark_for_delete,
  p_partkey % 5 <> 1 AS valid_brand
FROM {{part}}
UNION ALL SELECT p_name, p_partkey % 8 = 4, TRUE FROM {{part}} WHERE p_partkey % 4 = 0
UNION ALL SELECT upper(substr(p_name, 1, 1)) || substr(p_name, 2), FALSE, TRUE FROM {{part}} WHERE p_partkey % 4 = 1
UNION ALL SELECT p_name || ' ', FALSE, TRUE FROM {{part}} WHERE p_partkey % 4 = 2
UNION ALL SELECT {_S}, FALSE, TRUE FROM {{part}} WHERE p_partkey = 5
"""


def _attributes(d: str) -> str:
    pt = lambda v: _struct(d, attribute_name="'product_type'", attribute_value=v)
    color = _struct(d, attribute_name="'color'", attribute_value="split_part(p_name, ' ', 1)")
    return f"""
SELECT CASE WHEN p_partkey % 11 = 0 THEN {_S} ELSE 'SKU-' || CAST(p_partkey AS STRING) END AS item_sku,
  CASE WHEN p_partkey % 6 = 0 THEN {_array(d, pt('p_type'), pt('p_name'), color)}
       ELSE {_array(d, pt('p_type'))} END AS std_prediction
FROM {{part}}
"""


def _seller(d: str) -> str:
    return f"""
SELECT CASE WHEN s_suppkey % 3 = 0 THEN lower(s_name) ELSE s_name END AS business_partner_name,
  CASE WHEN s_suppkey % 11 = 0 THEN {_S} ELSE 'BP' || CAST(s_suppkey AS STRING) END AS business_partner_code,
  CASE WHEN s_suppkey % 5 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS merchant_status,
  s_suppkey % 7 <> 0 AS company_merchant_flag,
  s_suppkey % 13 = 0 AS mark_for_delete
FROM {{supplier}}
"""


def _status(d: str, version: int) -> str:
    if version == 1:
        terms = (f"SELECT {_KEYWORD} AS kw FROM {{part}} UNION ALL SELECT upper({_KEYWORD}) FROM {{part}} "
                 "WHERE p_partkey % 2 = 0")
        status = (f"CASE length(kw) % 4 WHEN 0 THEN 'OK' WHEN 1 THEN 'ok' WHEN 2 THEN {_S} "
                  "ELSE 'TIMEOUT: Request timed out after 30s' END")
    else:
        terms = (f"SELECT {_KEYWORD} AS kw FROM {{part}} WHERE p_partkey % 3 <> 0 "
                 f"UNION ALL SELECT upper({_KEYWORD}) FROM {{part}} WHERE p_partkey % 3 = 0")
        status = f"CASE length(kw) % 3 WHEN 0 THEN 'OK' WHEN 1 THEN 'HTTP_ERROR: 500' ELSE {_S} END"
    return f"SELECT kw AS search_internal_keyword, {status} AS status FROM ({terms}) t"


def _responses(d: str) -> str:
    """What the category service answered for each part's keyword; keywords of every eleventh part were never answered."""
    def body(text: str) -> str:      # a JSON literal, its braces doubled for the table names' formatting
        return "'" + text.replace("{", "{{").replace("}", "}}") + "'"

    head = '{"code": 200, "status": "OK"'
    size, group = "CAST(CAST(p_size AS INT) AS STRING)", "CAST(p_partkey % 25 AS STRING)"
    first = " || ".join([
        body(head + ', "data": {"isGenericTerm": false, "isValidC3": true, "categoryHierarchyList": [{"score": '), size,
        body('.5, "c1CategoryCode": "C1-'), "CAST(p_partkey % 5 AS STRING)", body('", "c2CategoryCode": "C2-'), group,
        body('", "c3CategoryCode": "C3-'), _SUPPLIER_OF_PART_TEXT, body('", "c3_name": "'), "lower(kw)",
        body('", "c3_category": "C1-'), "CAST(p_partkey % 5 AS STRING)", body("/C2-"), group, body("/C3-"),
        _SUPPLIER_OF_PART_TEXT, body('"}')])
    second = "CASE WHEN p_partkey % 2 = 0 THEN " + body(', {"score": 0.25, "c1CategoryCode": "C1-second"}') + " ELSE '' END"
    return f"""
SELECT kw AS search_internal_keyword,
  CASE p_partkey % 7
    WHEN 0 THEN {first} || {second} || {body("]}}")}
    WHEN 1 THEN {body(head + "}")}
    WHEN 2 THEN {body(head + ', "data": {"isGenericTerm": true, "isValidC3": false, "categoryHierarchyList": []}}')}
    WHEN 3 THEN {body('{"code": 404, "status": "NOT_FOUND", "data": null}')}
    WHEN 4 THEN {body('{"code": 200, "status": ')}
    ELSE {_S} END AS response,
  CASE p_partkey % 7 WHEN 5 THEN CASE WHEN p_partkey % 2 = 0 THEN 'TIMEOUT' ELSE 'HTTP_ERROR' END
    WHEN 6 THEN CASE WHEN p_partkey % 4 = 0 THEN {_S} ELSE 'ERROR' END ELSE {_S} END AS error_type,
  CASE p_partkey % 7 WHEN 5 THEN CASE WHEN p_partkey % 2 = 0 THEN 'Request timed out after 30s'
      ELSE '503 Server Error: Service Unavailable' END
    WHEN 6 THEN CASE WHEN p_partkey % 4 = 1 THEN 'unexpected end of stream' ELSE {_S} END ELSE {_S} END AS error_message
FROM (SELECT {_KEYWORD} AS kw, p_partkey, p_size FROM {{part}} WHERE p_partkey % 11 <> 10
      UNION SELECT upper({_KEYWORD}), p_partkey, p_size FROM {{part}} WHERE p_partkey % 11 <> 10) t
"""


# name -> (adapter dependencies, SQL builder)
FIXTURES = {
    "fx_base": (("events", "lineitem", "part", "supplier", "nation"), _base),
    "fx_view": (("fx_base", "lineitem"), _view),
    "fx_click": (("fx_base",), _click),
    "fx_sessions": (("fx_base",), _sessions),
    "fx_members": (("fx_base",), _members),
    "fx_members_with_null": (("fx_base",), lambda d: _members(d, keep_null=True)),
    "fx_stopwords": (("part",), _stopwords),
    "fx_category": (("region", "customer", "nation", "supplier", "part"), _category),
    "fx_kw_category": (("part", "supplier"), _kw_category),
    "fx_keywords": (("part", "supplier"), _keywords),
    "fx_ner": (("part",), _ner),
    "fx_brand": (("part",), _brand),
    "fx_attributes": (("part",), _attributes),
    "fx_seller": (("supplier",), _seller),
    "fx_status_v1": (("part",), lambda d: _status(d, 1)),
    "fx_status_v2": (("part",), lambda d: _status(d, 2)),
    "fx_responses": (("part", "supplier"), _responses),
}


REPLACED_BEFORE = _dt.date(2024, 1, 14)     # the test table is replaced before and appended from this day


# Spellings outside ASCII and their NFKC forms (full width, ligature, superscript, circled,
# roman numeral, composed accent, half-width katakana, no-break space).
NFKC_FORMS = (("ＳＨＯＥ", "SHOE"), ("ﬁne", "fine"), ("x²", "x2"), ("①", "1"), ("Ⅻ", "XII"), ("cafe\u0301", "caf\u00e9"),
              ("ｶﾞ", "ガ"), ("a\u00a0b", "a b"))


def nfkc_terms_sql(part: str = "{part}", forms: bool = False) -> str:
    """Terms in spellings that NFKC changes; with ``forms`` the expected forms beside them."""
    def case(k: int) -> str:
        return f"CASE p_partkey % {len(NFKC_FORMS) + 1} " + " ".join(
            f"WHEN {i} THEN '{f[k]} '" for i, f in enumerate(NFKC_FORMS)) + " ELSE '' END || p_name"
    more = f", {case(1)} AS form" if forms else ""
    return f"SELECT p_partkey AS id, CASE WHEN p_partkey % 23 = 0 THEN {_S} ELSE {case(0)} END AS term{more} FROM {part}"


def csv_terms_sql(part: str = "{part}") -> str:
    """Terms with quotes, commas, line ends, outer spaces, back slashes, nulls and empty strings; some sizes are no number."""
    return f"""
SELECT p_partkey AS id,
  CASE p_partkey % 7 WHEN 0 THEN {_S} WHEN 1 THEN '' WHEN 2 THEN p_name || '", "' || chr(10) || p_type
    WHEN 3 THEN ' ' || p_name || ' ' WHEN 4 THEN chr(92) || p_name || chr(92) || '"' WHEN 5 THEN '"' || chr(10) || ','
    ELSE p_name END AS term,
  CASE WHEN p_partkey % 17 = 0 THEN 'many' WHEN p_partkey % 19 = 0 THEN {_S}
    ELSE CAST(CAST(p_size AS INT) AS STRING) END AS size
FROM {part}
"""


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen or n not in FIXTURES:
            return
        for dep in FIXTURES[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def duckdb_ctes(names) -> str:
    """``WITH`` prefix defining the named adapters (and their dependencies) for DuckDB."""
    parts = []
    for n in _order(names):
        deps = {t: t for t in FIXTURES[n][0]}
        parts.append(f"{n} AS (\n{FIXTURES[n][1]('duckdb').format(**deps)}\n)")
    return "WITH " + ",\n".join(parts) + "\n"


class Fixtures:
    """Spark adapters for one data directory, built on first use.

    Adapters are written once to the shared checkpoint folder (as the
    warehouse tables they stand for would be) and read back as Parquet.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self._materialize = materialize
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    __getitem__ = table

    def view(self, name: str) -> DataFrame:
        """The rows of an adapter without storing them: a reader of few columns makes no others."""
        if name in self._frames or name not in FIXTURES:
            return self.table(name)
        deps, builder = FIXTURES[name]
        return self.spark.sql(builder("spark"), **{t: self.table(t) for t in deps})

    def _build(self, name: str) -> DataFrame:
        if name not in FIXTURES:
            return read_table(self.spark, self.sf_dir, name)
        df = self.view(name)
        if self._materialize:
            from .tables import materialize
            df = materialize(df, f"{name}-{uuid.uuid4().hex[:8]}")
        return df
