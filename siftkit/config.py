"""Job parameters and the fixed values the jobs must reproduce.

Everything a deployment changes (accounts, zone, dates, catalog) lives in
the dataclasses; the defaults are the production values of the studied
queries. The key lists and sentinels below are fixed: changing them changes
the meaning of the output columns.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values (must equal the studied queries for identical results)
# --------------------------------------------------------------------------

# Screening of search events (the account names are deployment parameters: SearchConfig).
SEARCH_PAGE_TYPES = ("search", "searchpage", "n-1 page")
INVALID_SEARCH_IDS = ("", "undefined")
EXCLUDED_CLIENT_STATUSES = ("INTERNAL", "GOOGLE_BOT")
LOCAL_ZONE = "Asia/Jakarta"
WEB_APP_VERSION = "WEB"

# Business channel of a web-account event, by device type.
# "N/A" maps to "<web account>(N/A)".
WEB_DEVICE_CHANNELS = (
    ("MOBILE", "MOBILE-WEB"),
    ("TABLET", "TABLET-WEB"),
    ("DESKTOP", "DESKTOP-WEB"),
    ("N/A", None),
)

# Key/value pivot of extension_data: output column -> keys feeding it.
VIEW_KV_COLUMNS = (
    ("is_intent_minded", ("is_intent_minded",)),
    ("is_seeded_query", ("is_seeded_query",)),
    ("is_spellcheck_result", ("is_spellcheck_result",)),
    ("is_ner_applied", ("is_ner_applied",)),
    ("is_ner_eligible", ("is_ner_eligible",)),
    ("all_category_clicked", ("all_category_clicked",)),
    ("search_keyword_type", ("search_keyword_type",)),
    ("refined_original_search_keyword", ("refined_original_search_keyword",)),
    ("appliedQuickFilters", ("appliedQuickFilters",)),
    ("quick_filters", ("quick_filters",)),
    ("recently_used_filters", ("recently_used_filters",)),
    ("applied_displayed_filters", ("applied_displayed_filters",)),
    ("algo_id", ("algo_id",)),
    ("algo_name", ("algo_name", "algo")),
    ("result_type", ("result_type",)),
    ("source", ("source",)),
    ("error_status_code", ("error_status_code",)),
    ("ds_category_ids", ("ds_category_ids",)),
)

CLICK_KV_COLUMNS = (
    ("is_intent_minded", ("is_intent_minded",)),
    ("is_ner_applied", ("is_ner_applied",)),
    ("is_ner_eligible", ("is_ner_eligible",)),
    ("all_category_clicked", ("all_category_clicked",)),
    ("search_keyword_type", ("search_keyword_type",)),
    ("refined_original_search_keyword", ("refined_original_search_keyword",)),
    ("appliedQuickFilters", ("appliedQuickFilters",)),
    ("quick_filters", ("quick_filters",)),
    ("recently_used_filters", ("recently_used_filters",)),
    ("applied_displayed_filters", ("applied_displayed_filters",)),
    ("algo_id", ("algo_id",)),
    ("algo_name", ("algo_name", "algo")),
    ("result_type", ("result_type",)),
    ("discount", ("discount",)),
    ("error_status_code", ("error_status_code",)),
)

# Category tree.
CATALOG_CODE = "12051"
CATEGORY_LEVELS = 8
MISSING_CATEGORY = "404 error"
PATH_SEPARATOR = "/"

# Keyword facts and category mapping window.
FACTS_DATE_FROM = _dt.date(2025, 1, 1)
FACTS_DATE_TO = _dt.date(2026, 1, 5)

# Keyword intent.
NER_ATTRIBUTES = ("brand", "product_type")
PRODUCT_TYPE_ATTRIBUTE = "product_type"
ACTIVE_MERCHANT = "ACTIVE"
NON_LATIN_PATTERN = "[^a-z0-9 ]"
WHITESPACE_RUN_PATTERN = r"\s+"
INTENT_LABELS = ("mixed", "brand", "seller", "product_type", "other")

# Fuzzy thresholds: (longest keyword length with distance 1, distance above it).
DICTIONARY_DISTANCE = (7, 2)
NER_DISTANCE = (5, 2)
MAX_LENGTH_GAP = 2

# Category enrichment.
MISSING_VALUE_SENTINELS = ("", " ", "na", "null", "n/a", "-")
OK_STATUS = "ok"
SUCCESS_CODE = 200
DEFAULT_BATCH_SIZE = 50000
ERROR_CLASSES = ("SKIP", "TIMEOUT", "CONNECTION_ERROR", "HTTP_ERROR", "JSON_ERROR", "ERROR")
SKIP_MESSAGE = "Empty or null search term"
TIMEOUT_MESSAGE = "Request timed out after 30s"
CONNECTION_MESSAGE = "Failed to connect to API"
JSON_MESSAGE = "Invalid JSON response"


@dataclass(frozen=True)
class SearchConfig:
    """Row screening of the search-event jobs.

    ``accounts`` are the upper-cased account ids kept (compared case-folded);
    ``web_account`` is the one whose device type decides the channel.
    """

    accounts: tuple
    web_account: str
    date_from: _dt.date = _dt.date(2025, 1, 1)
    zone: str = LOCAL_ZONE
    page_types: tuple = SEARCH_PAGE_TYPES
    invalid_search_ids: tuple = INVALID_SEARCH_IDS
    excluded_statuses: tuple = EXCLUDED_CLIENT_STATUSES
    web_app_version: str = WEB_APP_VERSION
    device_channels: tuple = WEB_DEVICE_CHANNELS


@dataclass(frozen=True)
class FactsConfig:
    """Date window and catalog of the category and keyword jobs."""

    date_from: _dt.date = FACTS_DATE_FROM
    date_to: _dt.date = FACTS_DATE_TO
    catalog_code: str = CATALOG_CODE
    levels: int = CATEGORY_LEVELS


@dataclass(frozen=True)
class EnrichConfig:
    """Batching of the category enrichment job."""

    batch_size: int = DEFAULT_BATCH_SIZE
    sentinels: tuple = MISSING_VALUE_SENTINELS
    ok_status: str = OK_STATUS
    success_code: int = SUCCESS_CODE
    extra: dict = field(default_factory=dict)
