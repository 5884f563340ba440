"""Keyword normalisation.

Everything is a JVM expression except Unicode NFKC, which Spark has no
built-in for. NFKC leaves ASCII unchanged, so only non-ASCII values are
sent to the Python worker; ASCII rows pass a null through Arrow.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..config import NON_LATIN_PATTERN, WHITESPACE_RUN_PATTERN


def _nfkc_value(v):
    if isinstance(v, str):
        return v if v.isascii() else unicodedata.normalize("NFKC", v)
    return None


@F.pandas_udf(StringType())
def _nfkc_batch(s: pd.Series) -> pd.Series:
    return s.map(_nfkc_value)


def is_ascii(c: Column) -> Column:
    """True when every character is ASCII (character count equals byte count)."""
    return F.length(c) == F.octet_length(c)


def nfkc(c: Column) -> Column:
    """NORMALIZE(s, NFKC)."""
    ascii_only = is_ascii(c)
    return F.when(c.isNull() | ascii_only, c).otherwise(_nfkc_batch(F.when(~ascii_only, c)))


def nfkc_lookup(values: DataFrame, col: str) -> DataFrame:
    """X6 as a side table: (raw, form) of the distinct values that are not ASCII, each normalised once.

    Store it where several dictionaries read it. Values reach the Python worker once each, however often rows
    repeat them; copies are dropped in every task before the shuffle.
    """
    raw = values.select(F.col(col).alias("raw")).where(~is_ascii(F.col("raw"))).distinct()
    return raw.select("raw", _nfkc_batch(F.col("raw")).alias("form"))


def with_nfkc(df: DataFrame, col: str, lookup: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``: the NFKC form of ``col`` from a stored :func:`nfkc_lookup`; ASCII and null values as they are."""
    found = lookup.select(F.col("raw").alias("__raw"), F.col("form").alias("__form"))
    # ASCII rows carry a null key: they match nothing and are never one hot key of the shuffle
    key = F.when(~is_ascii(F.col(col)), F.col(col))
    joined = df.join(found, key == F.col("__raw"), "left")
    return joined.withColumn(out, F.coalesce("__form", col)).drop("__raw", "__form")


def latin_form(c: Column) -> Column:
    """U2 after NFKC: non [a-z0-9 ] to space, spaces squeezed, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(c, NON_LATIN_PATTERN, " "), WHITESPACE_RUN_PATTERN, " ")))


def norm_str(c: Column) -> Column:
    """Lower -> NFKC -> non [a-z0-9 ] to space -> squeeze spaces -> trim -> lower."""
    return latin_form(nfkc(F.lower(c)))


def norm_dict(c: Column) -> Column:
    """The dictionary normaliser of the fuzzy job: NFKC -> strip -> lower.

    Characters outside [a-z0-9 ] are replaced before lower-casing and the
    result is not trimmed, so capitals become spaces (kept on purpose).
    """
    return F.lower(F.regexp_replace(nfkc(c), NON_LATIN_PATTERN, " "))


def first_char(c: Column) -> Column:
    """SUBSTR(s, 1, 1)."""
    return F.substring(c, 1, 1)


def edit_distance_within(a: Column, b: Column, limit: Column | int) -> Column:
    """X12 with a limit: the Levenshtein distance when it is <= limit, else null.

    Spark's three-argument form stops early and returns -1 above the limit.
    """
    if isinstance(limit, int):
        d = F.levenshtein(a, b, limit)
        return F.when(d >= 0, d)
    d = F.levenshtein(a, b)
    return F.when(d <= limit, d)
