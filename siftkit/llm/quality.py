"""Operator 3: line-first cleaning with base statistics, in SQL functions only."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, WORD, table

# Fixed values of the contract.
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30

# Parameters of the line rules; lengths are code points of the line.
MAX_SYMBOL_PCT = 7        # symbol characters per hundred characters
NAV_SEPARATORS = 3        # menu separators standing alone in one line
SEPARATORS = ("|", ">", "·", "•", "»")
SHOUT_PCT = 45            # capital letters per hundred characters
LONG_LINE = 45            # from this length a line needs a sentence mark
STOCK_LINE = 200          # stock phrases are looked for in lines up to this length
MAX_LOST_PCT = 50         # documents losing more of their lines' characters are rejected
BOILERPLATE = ("all rights reserved", "terms of service", "terms of use", "privacy policy", "cookie policy",
               "we use cookies", "accept cookies", "enable javascript", "javascript is disabled",
               "subscribe to our newsletter", "click here to", "skip to content", "lorem ipsum")
_MENU = "[" + "".join(SEPARATORS) + "]"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (bound as a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def _n_repeat(hashes: Column) -> Column:
    """Words (given by hash) covered by 8-word windows that occur twice or more, first occurrence included."""
    def covered(starts: Column) -> Column:
        reach = F.transform(starts, lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda s, x: s + x)

    def starts_of(sorted_grams: Column) -> Column:
        again = F.filter(sorted_grams, lambda g, i:
                         F.coalesce(F.get(sorted_grams, i + 1)["h"] == g["h"], F.lit(False))
                         | ((i > 0) & F.coalesce(F.get(sorted_grams, F.greatest(i - 1, F.lit(0)))["h"] == g["h"],
                                                 F.lit(False))))
        return F.sort_array(F.transform(again, lambda g: g["p"]))

    def grams_of(h: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - n),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)]))

    def unique(grams: Column) -> Column:
        return F.size(F.array_distinct(grams)) == F.size(grams)

    def from_grams(grams: Column) -> Column:
        ranked = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(unique(grams), F.lit(0).cast("long")).otherwise(_let(_let(ranked, starts_of), covered))

    def from_hashes(h: Column) -> Column:
        # a repeated 8-word window holds a repeated half window; most texts have none
        return F.when(_let(grams_of(h, WINDOW // 2), unique), F.lit(0).cast("long")).otherwise(
            _let(grams_of(h, WINDOW), from_grams))

    return F.when(F.size(hashes) <= WINDOW, F.lit(0).cast("long")).otherwise(from_hashes(hashes))


def _line(line: Column) -> Column:
    """One line: its length, symbols, and whether it fails a rule. Cheap tests come first."""
    def fails(length: Column, symbols: Column) -> Column:
        menu = F.size(F.filter(F.split(line, f"{SPACE}+"), lambda x: x.isin(*SEPARATORS)))
        return (
            ((symbols >= 3) & (symbols * 100 > length * MAX_SYMBOL_PCT))                       # punctuation
            | ((length >= LONG_LINE) & ~line.rlike(r"[.!?…。;:]"))
            | (line.rlike(_MENU) & (menu >= NAV_SEPARATORS))                                   # navigation
            | (F.regexp_count(line, F.lit(r"\p{Lu}")) * 100 > length * SHOUT_PCT)           # boilerplate
            | ((length <= STOCK_LINE) & _let(F.lower(line), lambda low: functools.reduce(
                operator.or_, [F.contains(low, F.lit(p)) for p in BOILERPLATE])))
        )

    facts = F.struct(F.length(line).cast("long").alias("n"),
                     F.regexp_count(line, F.lit(SYMBOLS)).cast("long").alias("symbols"))
    return _let(facts, lambda x: F.struct(x["n"].alias("n"), x["symbols"].alias("symbols"),
                                          fails(x["n"], x["symbols"]).alias("fails")))


def score_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the base statistics and the verdict to each row of ``docs``.

    Lines are the text split at ``\\n``; lines without a word are passed
    over. A line fails if it breaks a punctuation rule (too many symbols; a
    long line without any sentence mark), a navigation rule (stand-alone
    menu separators) or a boilerplate rule (shouting, stock phrases); :func:`clean_lines`
    removes failing lines from a text.
    A document is kept unless ``base_failed`` (fewer than 20 words, or over
    30 % repeated words) or the failing lines hold over half of the
    characters of its lines. Only SQL functions are used; no row is shuffled.

    Null and empty texts: all counts 0, base_failed, not kept. Long texts are read whole. Rows are judged one by one, so ties,
    repeated rows and extra columns pass through unchanged; an added
    column replaces one of the same name. No rows: no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"),
                        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                        _let(F.transform(words, lambda w: F.xxhash64(w)), _n_repeat).alias("n_repeat_words"))

    zero = F.lit(0).cast("long")

    def total(judged: Column, part) -> Column:
        return F.aggregate(judged, zero, lambda s, x: s + part(x))

    def of_lines(lines: Column) -> Column:
        return F.struct(
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _let(F.transform(lines, _line), lambda judged: F.struct(
                total(judged, lambda x: x["n"]).alias("n"), total(judged, lambda x: x["symbols"]).alias("symbols"),
                total(judged, lambda x: F.when(x["fails"], x["n"]).otherwise(zero)).alias("lost"))).alias("sums"))

    kept_columns = [c for c in docs.columns if c not in _ADDED]
    # every word and line list is bound once inside its expression
    step = docs.select(
        *kept_columns, _let(words_of(F.col(text_col)), of_words).alias("__q_words"),
        _let(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)), of_lines).alias("__q_lines"))
    step = step.select(*kept_columns, "__q_words.*", "__q_lines.n_dup_lines",
                       F.col("__q_lines.sums.symbols").alias("n_symbols"),
                       F.col("__q_lines.sums.n").alias("line_chars"), F.col("__q_lines.sums.lost").alias("lost_chars"))
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)
    return step.withColumns({
        "base_failed": base,
        "kept": ~base & (F.col("lost_chars") * 100 <= F.col("line_chars") * MAX_LOST_PCT)})


_ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
          "lost_chars", "line_chars", "__q_words", "__q_lines")


def clean_lines(text: Column) -> Column:
    """The text without its failing lines (lines without a word stay)."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(WORD) | ~_line(x)["fails"]), "\n")


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept")
