"""Delimited category paths and value predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PATH_SEPARATOR


def split_path(c: Column, sep: str = PATH_SEPARATOR) -> Column:
    """SPLIT(s, sep); '' gives [''], null gives null."""
    return F.split(c, _regex_literal(sep), -1)


def path_part(c: Column, index: int, sep: str = PATH_SEPARATOR) -> Column:
    """SPLIT(s, sep)[SAFE_OFFSET(i)] - zero-based, null when out of range."""
    return F.get(split_path(c, sep), index)


def not_blank(c: Column) -> Column:
    """P10: non-null and not the empty string."""
    return c.isNotNull() & (c != F.lit(""))


def valid_token(c: Column, invalid: tuple) -> Column:
    """Not null and not one of the invalid literals."""
    return c.isNotNull() & ~c.isin(*invalid)


def is_missing(c: Column, sentinels: tuple) -> Column:
    """Null, or a lower-cased sentinel such as 'na' or '-'."""
    return c.isNull() | F.lower(c).isin(*sentinels)


def null_or_empty(c: Column) -> Column:
    """X24."""
    return c.isNull() | (c == F.lit(""))


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in sep)
