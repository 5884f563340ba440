"""DuckDB oracle SQL for every registered query.

Stated from the meaning of each job over the same adapter tables as the
Spark side (``siftkit.sources.fixtures``): screening as EXISTS conditions
with the null rule of NOT IN spelled out, nested records as list
expressions over a window, category paths by recursion, dictionaries as one
tagged table with one matching step, labels from the number of flags set.
Ties and ANY_VALUE take the choice that the Spark jobs state. DuckDB has no
NFKC; on the adapter data NFKC changes nothing.
"""

from __future__ import annotations

from siftkit.config import CLICK_KV_COLUMNS, MISSING_CATEGORY, MISSING_VALUE_SENTINELS, VIEW_KV_COLUMNS
from siftkit.sources.fixtures import (ENRICH_CFG, FACTS_CFG, REPLACED_BEFORE, SEARCH_CFG, ZONE_OFFSET_HOURS, csv_terms_sql,
                                      duckdb_ctes, nfkc_terms_sql)

_cfg = SEARCH_CFG
_F = FACTS_CFG
KW = "search_internal_keyword"
GROUP = f"search_id, session_id, {KW}"

ORACLE: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _with(tables, *relations: tuple[str, str]) -> str:
    """The adapter tables, then named relations, each over those before it (and itself)."""
    head = duckdb_ctes(list(dict.fromkeys(tables))).rstrip().replace("WITH ", "WITH RECURSIVE ", 1)
    return head + "".join(f",\n{name} AS ({body})" for name, body in relations) + "\n"


# ---------------------------------------------------------------- J1, J2
_LOCAL = f"datetime + INTERVAL {ZONE_OFFSET_HOURS} HOUR"
_EXCLUDED = f"list_contains({_list(_cfg.excluded_statuses)}, m.client_status)"
_VERSION = f"if(coalesce(account_id = {_text(_cfg.web_account)}, FALSE), {_text(_cfg.web_app_version)}, app_version)"


def _channel() -> str:
    """A lookup of (device, label) for web rows; the account itself for all others."""
    labels = {device: label or f"{_cfg.web_account}({device})" for device, label in _cfg.device_channels}
    found = "MAP {" + ", ".join(f"{_text(d)}: {_text(label)}" for d, label in labels.items()) + "}[device_type]"
    return f"coalesce(if(account_id = {_text(_cfg.web_account)}, {found}, NULL), account_id)"


def _not_in(value: str, table: str, member: str, where: str = "TRUE") -> str:
    """NOT IN by its rule: nothing equal; and over a set that is not empty, no null on either side."""
    of = f"SELECT 1 FROM {table} m WHERE {where}"
    return (f"NOT EXISTS ({of} AND {member} = {value}) AND NOT EXISTS ({of} AND {member} IS NULL) "
            f"AND ({value} IS NOT NULL OR NOT EXISTS ({of}))")


def _in_scope() -> str:
    return " AND ".join([
        f"{_LOCAL} >= TIMESTAMP '{_cfg.date_from.isoformat()} 00:00:00'",
        f"list_contains({_list(_cfg.accounts)}, upper(account_id))",
        f"list_contains({_list(_cfg.page_types)}, catalog_page_type)",
        f"NOT list_contains({_list(_cfg.invalid_search_ids)}, search_id)",
        "search_result_count > 0"])


_KNOWN_SESSION = "EXISTS (SELECT 1 FROM fx_sessions s WHERE s.session_id = r.session_id)"
_ALLOWED_SESSION = _not_in("r.session_id", "fx_members", "m.session_id", _EXCLUDED)
_NO_STOPWORD = _not_in(f"lower(r.{KW})", "fx_stopwords", "lower(m.stopword_keyword)")


def _skus(products: str) -> str:
    """Distinct sorted SKUs that are not blank, joined by commas; null when there are none."""
    given = f"list_filter(list_transform({products}, lambda p: p.sku), lambda s: s <> '')"
    return f"nullif(array_to_string(list_sort(list_distinct({given})), ','), '')"


def _kv(spec, entries: str) -> str:
    """The greatest value that is not blank for the keys of each column."""
    return ", ".join(
        f"list_max(list_transform(list_filter({entries}, lambda e: list_contains({_list(keys)}, e.key) AND e.val <> ''), "
        f"lambda e: e.val)) AS {name}" for name, keys in spec)


def _of_group(items: str) -> str:
    """All entries of a row's group; none where the group has no keyword (null meets no group)."""
    return f"if({KW} IS NULL, NULL, flatten(list({items}) OVER (PARTITION BY {GROUP})))"


def _search_job(source: str, unused: str, time_name: str, spec, products: bool) -> str:
    skus = f"{_skus('products')} AS skus, " if products else ""
    gather = f"{_of_group('product_list')} AS products, " if products else ""
    drop = "entries, products" if products else "entries"
    return f"""
  SELECT * EXCLUDE ({drop}), {skus}{_kv(spec, 'entries')}
  FROM (SELECT * EXCLUDE ({unused}) REPLACE ({_VERSION} AS app_version), {_channel()} AS business_channel,
          CAST({_LOCAL} AS DATE) AS date, {_LOCAL} AS {time_name}, {gather}{_of_group('extension_data')} AS entries
        FROM {source} r
        WHERE {_in_scope()}
          AND {_KNOWN_SESSION}
          AND {_ALLOWED_SESSION}
          AND {_NO_STOPWORD})"""


VIEWS = ("views", _search_job("fx_view", "datetime, product_list, extension_data", "datetime", VIEW_KV_COLUMNS, True))
CLICKS = ("clicks", _search_job("fx_click", "datetime, extension_data, account_id, device_type", "event_datetime",
                                CLICK_KV_COLUMNS, False))
_SCREEN_FX = ["fx_sessions", "fx_members", "fx_stopwords"]
_VIEW_FX = ["fx_view", *_SCREEN_FX]
_CLICK_FX = ["fx_click", *_SCREEN_FX]

ORACLE["search_views"] = _with(_VIEW_FX, VIEWS) + "SELECT * FROM views"
ORACLE["search_clicks"] = _with(_CLICK_FX, CLICKS) + "SELECT * FROM clicks"

ORACLE["counted_frame"] = _with(_VIEW_FX, VIEWS) + """
SELECT *, count(*) OVER () AS rows
FROM (SELECT date, business_channel, count(DISTINCT session_id) AS sessions FROM views GROUP BY ALL)
"""

_SCREENED = f"SELECT search_id, session_id, {KW}, datetime FROM fx_view r WHERE "
ORACLE["screened_sessions"] = _with(["fx_view", "fx_sessions", "fx_members"]) + \
    f"{_SCREENED}{_KNOWN_SESSION} AND {_ALLOWED_SESSION}"
ORACLE["screened_sessions_null_set"] = _with(["fx_view", "fx_members_with_null"]) + \
    _SCREENED + _not_in("r.session_id", "fx_members_with_null", "m.session_id", _EXCLUDED)
ORACLE["screened_sessions_empty_set"] = _with(["fx_view"]) + f"SELECT search_id, session_id, {KW}, datetime FROM fx_view"
ORACLE["stopword_screen"] = _with(["fx_view", "fx_stopwords"]) + _SCREENED + _NO_STOPWORD
ORACLE["sku_lists"] = _with(["fx_view"]) + f"""
SELECT * FROM (SELECT {GROUP}, {_skus('flatten(list(product_list))')} AS skus FROM fx_view WHERE {_in_scope()} GROUP BY ALL)
WHERE skus IS NOT NULL
"""
ORACLE["kv_pivot"] = _with(["fx_view"]) + f"""
SELECT {GROUP}, {_kv(VIEW_KV_COLUMNS, 'entries')}
FROM (SELECT {GROUP}, flatten(list(extension_data)) AS entries FROM fx_view WHERE {_in_scope()} GROUP BY ALL)
"""
ORACLE["business_channel"] = _with(["fx_view"]) + f"""
SELECT search_id, session_id, datetime, account_id, device_type, {_channel()} AS business_channel, {_VERSION} AS app_version
FROM fx_view
"""


# ---------------------------------------------------------------- J3, J4
_ATTRS = {"id": "id", "code": "category_code", "name": "name", "name_english": "name_english"}
_NODE = "{" + ", ".join(f"'{out}': n.{col}" for out, col in _ATTRS.items()) + "}"
_ROOT = f"n.category_level = 1 AND n.catalog_code = {_text(_F.catalog_code)}"
_CHILD = "n.parent_category_id = t.nodes[-1].id AND n.category_level = len(t.nodes) + 1"


def _deepest(attr: str) -> str:
    known = f"list_filter(list_transform(nodes[2:], lambda x: x.{attr}), lambda v: v IS NOT NULL)"
    return f"coalesce({known}[-1], {_text(MISSING_CATEGORY)}) AS cn_{attr}"


TREE = ("tree", f"""
  SELECT [{_NODE}] AS nodes FROM fx_category n WHERE {_ROOT}
  UNION ALL
  SELECT list_append(t.nodes, {_NODE}) FROM tree t JOIN fx_category n ON {_CHILD} WHERE len(t.nodes) < {_F.levels}""")
# paths that cannot grow; a root alone is none
CHAINS = ("chains", f"""
  SELECT nodes FROM tree t
  WHERE len(nodes) > 1 AND (len(nodes) = {_F.levels} OR NOT EXISTS (SELECT 1 FROM fx_category n WHERE {_CHILD}))""")
_PATH_COLUMNS = ", ".join([*[f"nodes[{n}].{a} AS c{n}_{a}" for n in range(1, _F.levels + 1) for a in _ATTRS],
                           *[_deepest(a) for a in _ATTRS]])
ORACLE["category_paths"] = _with(["fx_category"], TREE, CHAINS) + f"SELECT DISTINCT {_PATH_COLUMNS} FROM chains"

# every path from a root, whatever the level numbers say, until it ends or meets one of its own nodes again
ORACLE["category_paths_any_depth"] = _with(["fx_category"], ("walk", f"""
  SELECT [n.id] AS ids, [n.category_code] AS codes, FALSE AS cyclic FROM fx_category n WHERE {_ROOT}
  UNION ALL
  SELECT list_append(w.ids, n.id), list_append(w.codes, n.category_code), list_contains(w.ids, n.id)
  FROM walk w JOIN fx_category n ON n.parent_category_id = w.ids[-1] WHERE NOT w.cyclic""")) + """
SELECT DISTINCT array_to_string(ids, '/') AS path_ids, array_to_string(codes, '/') AS path_codes, len(ids) AS depth, cyclic
FROM walk w WHERE cyclic OR NOT EXISTS (SELECT 1 FROM fx_category n WHERE n.parent_category_id = w.ids[-1])
"""

_DAYS = f"BETWEEN DATE '{_F.date_from.isoformat()}' AND DATE '{_F.date_to.isoformat()}'"
_PATH = "search_internal_category_id"

MENTIONED = ("mentioned", f"""
  SELECT DISTINCT {_PATH}, unnest(string_split({_PATH}, '/')) AS code FROM views WHERE CAST(datetime AS DATE) {_DAYS}""")
# the deepest level first, then the smallest code
DEEPEST = ("deepest", f"""
  SELECT {_PATH}, -top.up AS category_level, top.code AS category_code
  FROM (SELECT {_PATH}, min({{'up': -n.category_level, 'code': n.category_code}}) AS top
        FROM mentioned JOIN fx_category n ON n.category_code = code
        WHERE n.catalog_code = {_text(_F.catalog_code)} AND n.category_level IS NOT NULL GROUP BY 1)""")
# each place of a path with the path down to it: names below the place are not there
PLACES = ("places", f"""
  SELECT DISTINCT nodes[place].code AS code, place AS level, nodes[:least(place, 3)] AS upper
  FROM (SELECT nodes, unnest(range(1, {_F.levels + 1})) AS place FROM chains) WHERE nodes[place].code IS NOT NULL""")
_NAMES3 = ", ".join(f"upper[{n}].{a} AS c{n}_{a}" for a in ("name", "name_english") for n in (1, 2, 3))
_MAPPED = _with([*_VIEW_FX, "fx_category"], VIEWS, TREE, CHAINS, MENTIONED, DEEPEST, PLACES)

ORACLE["category_mapping"] = _MAPPED + f"""
SELECT DISTINCT {_PATH}, {_NAMES3}, d.category_level AS matched_level, d.category_code AS matched_category_code
FROM deepest d LEFT JOIN places p ON p.level = d.category_level AND p.code = d.category_code
"""
_ORDER = ", ".join(f"{c} NULLS FIRST" for c in (
    _PATH, *[f"c{n}_{a}" for a in ("name", "name_english") for n in (1, 2, 3)], "matched_level", "matched_category_code"))
ORACLE["mapping_in_order"] = f"""
SELECT *, row_number() OVER (ORDER BY {_ORDER}) - 1 AS position FROM ({ORACLE["category_mapping"]})
"""
ORACLE["path_explode"] = _MAPPED + "SELECT * FROM mentioned"
ORACLE["deepest_category"] = _MAPPED + "SELECT * FROM deepest"


# ---------------------------------------------------------------- J5
_FILLED = {"c1_code": ("parts[1]", "c1CategoryCode"), "c2_code": ("parts[2]", "c2CategoryCode"),
           "c3_code": ("parts[3]", "c3CategoryCode"), "ds_category_ids": ("ds_category_ids", "c3_category")}
_LOAD_COLUMNS = ("session_id, search_id, catalog_page_type, account_id, device_type, device, app_version, "
                 "search_result_count, business_channel, result_type, is_spellcheck_result, search_keyword_type, "
                 "search_internal_category_id")

GUESS = ("guess", f"""
  SELECT lower({KW}) AS kw, {", ".join(f"min({src}) AS {out}" for out, (_, src) in _FILLED.items())}
  FROM fx_kw_category WHERE c1CategoryCode IS NOT NULL GROUP BY ALL""")
LOADED = ("loaded", f"""
  SELECT DISTINCT day AS date, v.kw AS {KW}, {_LOAD_COLUMNS},
    {", ".join(f"coalesce({own}, g.{out}) AS {out}" for out, (own, _) in _FILLED.items())}
  FROM (SELECT CAST(datetime AS DATE) AS day, lower({KW}) AS kw, string_split(ds_category_ids, '/') AS parts,
          {_LOAD_COLUMNS}, ds_category_ids FROM views) v
  LEFT JOIN guess g ON g.kw = v.kw WHERE day {_DAYS}""".replace("coalesce(ds_category_ids,", "coalesce(v.ds_category_ids,"))
CLICKED = ("clicked", f"""
  SELECT DISTINCT session_id, search_id, lower({KW}) AS kw FROM clicks WHERE CAST(event_datetime AS DATE) {_DAYS}""")
# sessions for each keyword, pairs and keywords over all, from one list of what was seen
TALLY = ("tally", f"""
  SELECT kw, grouping(kw) = 1 AS overall, bool_or(load) AS was_loaded, bool_or(NOT load) AS was_clicked,
    count(DISTINCT session_id) FILTER (load) AS loads, count(DISTINCT session_id) FILTER (NOT load) AS clicks,
    count(DISTINCT session_id || kw) FILTER (load) AS load_pairs,
    count(DISTINCT session_id || kw) FILTER (NOT load) AS click_pairs, count(DISTINCT kw) FILTER (load) AS keywords
  FROM (SELECT TRUE AS load, {KW} AS kw, session_id FROM loaded UNION ALL SELECT FALSE, kw, session_id FROM clicked)
  GROUP BY GROUPING SETS ((kw), ())""")
_FACTS = _with([*_VIEW_FX, *_CLICK_FX, "fx_category", "fx_kw_category"], VIEWS, CLICKS, TREE, CHAINS, GUESS, LOADED,
               CLICKED, TALLY)
_NAMES6 = ", ".join(f"nodes[{n}].{a} AS c{n}_{a}" for a in ("name", "name_english") for n in (1, 2, 3))
_COUNTS = "loads AS search_loads, if(was_clicked, clicks, NULL) AS search_clicks"

ORACLE["keyword_facts"] = _FACTS + f"""
SELECT DISTINCT l.*, l.session_id AS loads_session_id, c.session_id AS clicks_session_id, {_COUNTS},
  s.* EXCLUDE (code), (SELECT load_pairs FROM tally WHERE overall) AS total_loads,
  (SELECT click_pairs FROM tally WHERE overall) AS total_clicks, (SELECT keywords FROM tally WHERE overall) AS total_keywords
FROM loaded l
LEFT JOIN clicked c ON (c.session_id, c.search_id, c.kw) = (l.session_id, l.search_id, l.{KW})
LEFT JOIN tally t ON t.kw = l.{KW} AND NOT t.overall
LEFT JOIN (SELECT DISTINCT nodes[3].code AS code, {_NAMES6} FROM chains) s ON s.code = l.c3_code
"""
ORACLE["keyword_loads_clicks"] = _FACTS + f"""
SELECT kw AS {KW}, {_COUNTS} FROM tally WHERE was_loaded AND NOT overall
"""
ORACLE["funnel_totals"] = _FACTS + """
SELECT load_pairs AS total_loads, click_pairs AS total_clicks, keywords AS total_keywords FROM tally WHERE overall
"""
ORACLE["keyword_category_any"] = _with(["fx_kw_category"], GUESS) + f"SELECT * RENAME (kw AS {KW}) FROM guess"
ORACLE["category_fill_in"] = _FACTS + "SELECT * FROM loaded"


# ---------------------------------------------------------------- J6, J7
def norm_str(s: str) -> str:
    """U2 without NFKC: the runs of letters and digits, joined by a space."""
    return f"array_to_string(regexp_extract_all(lower({s}), '[a-z0-9]+'), ' ')"


def norm_dict(s: str) -> str:
    return f"regexp_replace({s}, '[^a-z0-9 ]', ' ', 'g')"


_INTENT_FX = ["fx_keywords", "fx_ner", "fx_brand", "fx_attributes", "fx_seller"]
_TYPES = """SELECT 'product_type' AS kind, p.attribute_value AS raw
  FROM (SELECT unnest(std_prediction) AS p FROM fx_attributes WHERE item_sku IS NOT NULL) WHERE p.attribute_name = 'product_type'"""
_BRANDS = "SELECT 'brand' AS kind, brand_name AS raw FROM fx_brand WHERE valid_brand AND NOT mark_for_delete"
_SELLERS = "SELECT 'seller' AS kind, business_partner_name AS raw FROM fx_seller WHERE business_partner_code IS NOT NULL"

TYPED = ("typed", f"""
  SELECT DISTINCT {KW} AS kw, {norm_str(KW)} AS norm FROM fx_keywords""")
# one dictionary of all kinds and one matching step
NAMED = ("named", f"""
  {_BRANDS} UNION {_TYPES}
  UNION {_SELLERS} AND merchant_status = 'ACTIVE' AND company_merchant_flag AND NOT mark_for_delete""")
EQUAL = ("equal", f"SELECT kw, kind, raw FROM typed JOIN (SELECT *, {norm_str('raw')} AS form FROM named) ON form = norm")
TAGS = ("tags", f"""
  SELECT kw, attribute_name, unnest(attribute_values) AS raw
  FROM (SELECT {KW} AS kw, unnest(attributes, recursive := FALSE) AS a FROM fx_ner), LATERAL (SELECT a.attribute_name, a.attribute_values)
  WHERE list_contains(['brand', 'product_type'], attribute_name)""")
TAGGED = ("tagged", "SELECT t.kw, " + ", ".join(
    f"bool_or({hit}) AS {kind}_hit, max(if({hit}, g.raw, NULL)) AS {kind}_raw" for kind, hit in
    ((k, f"(g.attribute_name = '{k}' AND {norm_str('g.raw')} = t.norm)") for k in ("brand", "product_type")))
    + " FROM typed t LEFT JOIN tags g ON g.kw = t.kw GROUP BY t.kw")


def _label(brand: str, product_type: str, seller: str) -> str:
    """None set: other; more than one: mixed; else the one that is set."""
    names = f"['other', if({brand}, 'brand', if({seller}, 'seller', 'product_type')), 'mixed', 'mixed']"
    return f"{names}[1 + CAST({brand} AS INT) + CAST({product_type} AS INT) + CAST({seller} AS INT)]"


EXACT = ("exact", f"""
  SELECT *, {_label('is_brand_exact', 'is_product_type_exact', 'is_seller_exact')} AS intent_type_exact
  FROM (SELECT t.kw, t.norm, g.brand_hit, g.product_type_hit, b.raw AS brand_name, p.raw AS type_name, s.raw AS seller_name,
          coalesce(b.raw, g.brand_raw) AS brand_any, coalesce(p.raw, g.product_type_raw) AS type_any,
          b.kw IS NOT NULL OR coalesce(g.brand_hit, FALSE) AS is_brand_exact,
          p.kw IS NOT NULL OR coalesce(g.product_type_hit, FALSE) AS is_product_type_exact,
          s.kw IS NOT NULL AS is_seller_exact
        FROM typed t LEFT JOIN tagged g ON g.kw = t.kw
        {" ".join(f"LEFT JOIN equal {a} ON {a}.kw = t.kw AND {a}.kind = '{k}'"
                  for a, k in (("b", "brand"), ("p", "product_type"), ("s", "seller")))})""")
_EXACT = _with(_INTENT_FX, TYPED, NAMED, EQUAL, TAGS, TAGGED, EXACT)

# dictionary values share the first character and a length within two; a keyword's own tags are compared as they are
AIMS = ("aims", f"""
  SELECT kind, {norm_dict('raw')} AS value FROM ({_BRANDS} UNION {_TYPES} UNION {_SELLERS})""")
NEAR = ("near", f"""
  SELECT kw, kind, origin, min({{'edits': edits, 'value': value}}).value AS value
  FROM (SELECT e.*, kind, 'names' AS origin, value, levenshtein(norm, value) AS edits, 7 AS short
        FROM exact e JOIN aims a ON left(a.value, 1) = left(e.norm, 1) AND length(a.value) - length(e.norm) BETWEEN -2 AND 2
        UNION ALL
        SELECT e.*, attribute_name, 'tags', {norm_dict('raw')}, levenshtein(norm, {norm_dict('raw')}), 5
        FROM exact e JOIN tags g ON g.kw = e.kw)
  WHERE edits <= if(length(norm) <= short, 1, 2)
    AND NOT MAP {{'brand': is_brand_exact, 'product_type': is_product_type_exact, 'seller': is_seller_exact}}[kind]
  GROUP BY ALL""")
_FUZZY = _EXACT.rstrip() + f",\n{AIMS[0]} AS ({AIMS[1]}),\n{NEAR[0]} AS ({NEAR[1]})\n"
_SIDES = {"brand_master": ("brand", "names"), "brand_ner": ("brand", "tags"), "product_type_master": ("product_type", "names"),
          "product_type_ner": ("product_type", "tags"), "seller": ("seller", "names")}


def _near(kind: str, out: str) -> str:
    return _FUZZY + f"SELECT kw AS {KW}, value AS {out} FROM near WHERE kind = '{kind}' AND origin = 'names'"


ORACLE["normalized_text"] = f"SELECT doc_id, {norm_str('text')} AS normalized_text FROM documents"
ORACLE["ner_flat"] = _EXACT + f"""
SELECT kw AS {KW}, attribute_name, raw AS attribute_value_raw, {norm_str('raw')} AS attribute_value_norm FROM tags
"""
ORACLE["ner_exact"] = _EXACT + f"""
SELECT kw AS {KW}, brand_hit AS is_brand_exact_ner, product_type_hit AS is_product_type_exact_ner,
  brand_raw AS matched_brand_raw_ner, product_type_raw AS matched_product_type_raw_ner FROM tagged
"""
ORACLE["dictionary_exact_match"] = _EXACT + f"SELECT kw AS {KW}, kind AS dictionary, raw AS matched_raw FROM equal"
ORACLE["keyword_intent_exact"] = _EXACT + f"""
SELECT kw AS {KW}, norm AS normalized_keyword, brand_hit AS is_brand_exact_ner, product_type_hit AS is_product_type_exact_ner,
  nullif(brand_name IS NOT NULL, FALSE) AS is_brand_exact_master,
  nullif(type_name IS NOT NULL, FALSE) AS is_product_type_exact_dict,
  is_brand_exact, is_product_type_exact, is_seller_exact, brand_any AS matched_brand_raw,
  type_any AS matched_product_type_raw, seller_name AS matched_seller_raw, intent_type_exact
FROM exact
"""
ORACLE["fuzzy_brand_match"] = _near("brand", "matched_brand_master")
ORACLE["fuzzy_product_type_match"] = _near("product_type", "matched_product_type_master")
ORACLE["fuzzy_seller_match"] = _near("seller", "matched_seller")
ORACLE["fuzzy_ner_match"] = _FUZZY + f"""
SELECT kw AS {KW}, kind AS attribute_name, value AS matched_ner_value FROM near WHERE origin = 'tags'
"""
ORACLE["fuzzy_match_reference_norm"] = _with(["fx_brand"]) + f"""
SELECT value, length(value) AS len, left(value, 1) AS fc FROM (SELECT {norm_dict('raw')} AS value FROM ({_BRANDS}))
"""
ORACLE["fuzzy_match_norm_str"] = _with(_INTENT_FX) + f"""
SELECT kind AS dictionary, value, (SELECT count(DISTINCT {KW}) FROM fx_keywords k WHERE {norm_str(KW)} = value) AS keywords
FROM (SELECT DISTINCT kind, {norm_str('raw')} AS value FROM ({_BRANDS} UNION {_TYPES} UNION {_SELLERS}))
"""
ORACLE["keyword_intent_fuzzy"] = _FUZZY + f"""
SELECT kw AS {KW}, norm AS normalized_keyword,
  {", ".join(f"is_{kind}_exact OR m_{side} IS NOT NULL AS is_{kind}_fuzzy{side.removeprefix(kind)}, m_{side} AS matched_{side}"
             for side, (kind, _) in _SIDES.items())},
  {_label('(is_brand_exact OR coalesce(m_brand_master, m_brand_ner) IS NOT NULL)',
          '(is_product_type_exact OR coalesce(m_product_type_master, m_product_type_ner) IS NOT NULL)',
          '(is_seller_exact OR m_seller IS NOT NULL)')} AS intent_type_fuzzy
FROM exact LEFT JOIN (
  SELECT kw, {", ".join(f"max(value) FILTER (kind = '{kind}' AND origin = '{origin}') AS m_{side}"
                        for side, (kind, origin) in _SIDES.items())}
  FROM near GROUP BY kw) USING (kw)
"""


# ---------------------------------------------------------------- J8
_B = ENRICH_CFG.batch_size
_MISSING = f"coalesce(list_contains({_list(MISSING_VALUE_SENTINELS)}, lower(v.ds_category_ids)), TRUE)"


# answers of the service, read with the JSON functions
_FIRST = "$.data.categoryHierarchyList[0]"
_ANSWER = {"code": ("$.code", "INTEGER"), "status": ("$.status", "VARCHAR"),
           "isGenericTerm": ("$.data.isGenericTerm", "BOOLEAN"), "isValidC3": ("$.data.isValidC3", "BOOLEAN"),
           "score": (f"{_FIRST}.score", "DOUBLE"),
           **{k: (f"{_FIRST}.{k}", "VARCHAR") for k in
              ("c1CategoryCode", "c2CategoryCode", "c3CategoryCode", "c3_name", "c3_category")}}


def _answered(source: str, reached: str = "TRUE") -> str:
    """The answers of ``source`` flattened; ``fault`` is what stands in for the status of a failed call."""
    cols = ", ".join(f"CAST(json_extract_string(body, '{path}') AS {kind}) AS {name}" if name != "status" else
                     f"coalesce(fault, json_extract_string(body, '{path}')) AS status"
                     for name, (path, kind) in _ANSWER.items())
    return f"""
  SELECT * EXCLUDE (body, fault), {cols}
  FROM (SELECT * EXCLUDE (response, error_type, error_message),
          CASE WHEN error_type IS NULL AND json_valid(response) AND coalesce({KW}, '') <> '' THEN response END AS body,
          CASE WHEN coalesce({KW}, '') = '' THEN 'SKIP: Empty or null search term'
               WHEN NOT {reached} THEN 'CONNECTION_ERROR: Failed to connect to API'
               WHEN error_type <> '' THEN error_type || ': ' || coalesce(error_message, '')
               WHEN NOT coalesce(json_valid(response), FALSE)
               THEN 'JSON_ERROR: ' || coalesce(error_message, 'Invalid JSON response') END AS fault
        FROM ({source}))"""


_KNOWN_ANSWERS = f"(SELECT *, TRUE AS known FROM fx_responses) r USING ({KW})"


def _enrich_ctes() -> str:
    return _with([*_VIEW_FX, "fx_status_v1", "fx_status_v2", "fx_responses"], VIEWS, ("pending", f"""
  SELECT DISTINCT {KW} FROM views v
  WHERE {_MISSING} AND EXISTS (SELECT 1 FROM (FROM fx_status_v1 UNION ALL BY NAME FROM fx_status_v2) s
                               WHERE s.{KW} = v.{KW} AND lower(s.status) <> 'ok')""")).rstrip() + f""",
terms AS (
  SELECT search_internal_keyword, ROW_NUMBER() OVER (ORDER BY search_internal_keyword) - 1 AS position
  FROM pending WHERE search_internal_keyword IS NOT NULL
),
batches AS (
  SELECT search_internal_keyword, position, position // {_B} AS batch_id,
    CAST(CEIL((SELECT COUNT(*) FROM terms) / {_B}.0) AS BIGINT) AS total_batches,
    (position // {_B}) * {_B} AS batch_start,
    LEAST((position // {_B} + 1) * {_B}, (SELECT COUNT(*) FROM terms)) AS batch_end
  FROM terms
),
parsed AS (SELECT * EXCLUDE (known) FROM ({_answered(
    f"SELECT {KW}, batch_id, known, response, error_type, error_message FROM batches LEFT JOIN {_KNOWN_ANSWERS}",
    "coalesce(known, FALSE)")})
),
per_batch AS (
  SELECT batch_id, COUNT(*) AS records, COUNT(*) FILTER (WHERE code = 200) AS success,
    COUNT(*) FILTER (WHERE code IS DISTINCT FROM 200) AS failed
  FROM parsed GROUP BY batch_id
)"""


ORACLE["pending_terms"] = _enrich_ctes() + "\nSELECT * FROM pending"
ORACLE["term_batches"] = _enrich_ctes() + "\nSELECT * FROM batches"
ORACLE["enrich_terms"] = _enrich_ctes() + "\nSELECT * FROM parsed"
ORACLE["parse_predictions"] = _enrich_ctes() + "\nSELECT * EXCLUDE (batch_id) FROM parsed"
ORACLE["parse_stored_answers"] = _with(["fx_responses"]) + _answered("SELECT * FROM fx_responses")
ORACLE["prediction_outcomes"] = _with(["fx_view", "fx_responses"]) + f"""
SELECT {KW}, code, status FROM ({_answered(f'''
  SELECT * FROM (SELECT {KW} FROM fx_view UNION SELECT search_internal_category_id FROM fx_view) LEFT JOIN {_KNOWN_ANSWERS}''',
  "coalesce(known, FALSE)")})
"""
ORACLE["enrichment_summary"] = _enrich_ctes() + """,
all_rows AS (
  SELECT * FROM per_batch
  UNION ALL
  SELECT NULL, CAST(SUM(records) AS BIGINT), CAST(SUM(success) AS BIGINT), CAST(SUM(failed) AS BIGINT)
  FROM per_batch
)
SELECT batch_id, records, success, failed,
  100.0 * success / NULLIF((SELECT COUNT(*) FROM terms), 0) AS success_pct,
  100.0 * failed / NULLIF((SELECT COUNT(*) FROM terms), 0) AS failed_pct
FROM all_rows
"""
ORACLE["run_statistics"] = (ORACLE["enrichment_summary"].rstrip() + " ").replace(
    "\nSELECT batch_id, records", "\nSELECT (SELECT count(*) FROM terms) AS terms, 1 AS jobs, TRUE AS timed, batch_id, records")
# what the interrupted run wrote keeps the answers of its time
ORACLE["batch_resume"] = _enrich_ctes() + """
SELECT * REPLACE (CASE WHEN batch_id <= 1 AND status = 'OK' THEN 'EARLY' ELSE status END AS status) FROM parsed
"""


# ---------------------------------------------------------------- tables: replace, append, ledger, CSV, buckets
ORACLE["table_replace_append"] = _with(_VIEW_FX, VIEWS) + f"""
SELECT CAST(datetime AS DATE) AS day,
  CASE WHEN CAST(datetime AS DATE) < DATE '{REPLACED_BEFORE}' THEN 'replaced' ELSE 'appended' END AS load,
  count(*) AS n_rows, count(DISTINCT session_id) AS sessions, 0 AS outdated, TRUE AS refused
FROM views GROUP BY ALL
"""
ORACLE["ledger_resume"] = _enrich_ctes() + """
SELECT *, CASE WHEN batch_id = 0 THEN 'first' ELSE 'second' END AS load FROM parsed
"""
ORACLE["csv_round_trip"] = f"""
SELECT id, term, TRY_CAST(size AS INTEGER) AS size, coalesce(size = 'many', FALSE) AS rejected
FROM ({csv_terms_sql("part")}) t
"""
ORACLE["colocated_loads_clicks"] = _FACTS + f"""
SELECT l.kw AS {KW}, count(*) AS sessions_loaded, count(c.kw) AS sessions_clicked
FROM (SELECT DISTINCT session_id, {KW} AS kw FROM loaded) l
LEFT JOIN (SELECT DISTINCT session_id, kw FROM clicked) c ON (c.session_id, c.kw) = (l.session_id, l.kw) GROUP BY 1
"""
# the forms are literals beside each spelling; what follows them is lower-cased and stripped in SQL
ORACLE["nfkc_terms"] = f"""
SELECT id, term, CASE WHEN term IS NOT NULL THEN form END AS form,
  CASE WHEN term IS NOT NULL THEN lower(trim(regexp_replace(regexp_replace(lower(form), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))) END
    AS normalized,
  CASE WHEN term IS NOT NULL THEN lower(regexp_replace(form, '[^a-z0-9 ]', ' ', 'g')) END AS dictionary_form
FROM ({nfkc_terms_sql("part", forms=True)}) t
"""
