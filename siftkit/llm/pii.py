"""Operator 8: personal data by fixed patterns and bootstrapped contextual extraction."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, store, table, text_hash

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"             # kind of the spans that the method adds

MIN_SUPPORT = 3          # different seed values a pattern must have met
MIN_CONFIDENCE = 0.8     # of a pattern
ROUNDS = 3               # of the bootstrapping

# Fixed values of the contract.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match starts where no digit stands before, and takes whole runs of digits: the same matches as the
# plain pattern, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_RUN = re.compile(r"[0-9]\S*")
_SHAPE = re.compile(r"([0-9]+)|[^\W\d_]+")
_CORE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._/-]{4,}")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns: by kind as listed, then start."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            out.append(("email", start, done))
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _word(raw: str) -> str:
    """A context word: lower case without outer punctuation; empty if it holds a digit."""
    word = raw.strip(".,;:!?\"'()[]{}<>=#*").lower()
    return "" if any(c.isdigit() for c in word) else word


def _before(text: str, start: int) -> tuple[list[str], bool]:
    """The two words before a place, the nearer first, as they stand; whether the nearer one begins its line."""
    words, line_start = [], False
    while len(words) < 2:
        end = start
        while end > 0 and text[end - 1].isspace():
            end -= 1
        start = end
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        if start == end:
            break
        if not words:
            line_start = start == 0 or text[start - 1] == "\n"
        words.append(text[start:end])
    return words, line_start


def _after(text: str, end: int) -> str:
    """The next word behind the one that a value ends in."""
    n = len(text)
    while end < n and not text[end].isspace():
        end += 1
    while end < n and text[end].isspace():
        end += 1
    start = end
    while end < n and not text[end].isspace():
        end += 1
    return text[start:end]


def shape(value: str) -> str:
    """Runs of digits with their lengths, runs of letters, and all other characters as they are."""
    return _SHAPE.sub(lambda m: f"d{len(m[0])}" if m[1] else "a", value)


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns that a value stands in.

    The two words before it; the word before it with its shape; its shape
    with the word after it; and the label before it, a word that ends in
    one of ``: = #``, marked where it begins its line.
    """
    words, line_start = _before(text, start)
    near = _word(words[0]) if words else ""
    form, behind = shape(text[start:end]), _word(_after(text, end))
    out = []
    if len(words) == 2 and near and _word(words[1]):
        out.append(f"{_word(words[1])} {near}")
    if near:
        out.append(f"{near} <{form}>")
    if behind:
        out.append(f"<{form}> {behind}")
    if near and words[0][-1] in ":=#":
        out.append(f"{'^' if line_start else ''}{near}{words[0][-1]}")
    return out


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[list[str], str, int, int, bool]]:
    """(contexts, value, start, end, seed) of the base spans and of other words that hold a digit."""
    out = []
    taken = sorted((s, e) for _, s, e in base)
    for s, e in taken:
        out.append((contexts(text, s, e), text[s:e], s, e, True))
    last = 0
    for m in _RUN.finditer(text):
        start = m.start()
        while start > last and not text[start - 1].isspace():
            start -= 1
        last = m.end()
        core = _CORE.search(text, start, m.end())
        if not core:
            continue
        s, e = core.start(), core.end()
        while e > s and text[e - 1] in "._/-":
            e -= 1
        if e - s >= 5 and any("0" <= c <= "9" for c in text[s:e]) and not any(a < e and s < b for a, b in taken):
            out.append((contexts(text, s, e), text[s:e], s, e, False))
    return [c for c in out if c[0]]


_FOUND_SCHEMA = ("doc_id long, uid long, text_hash long, base array<struct<kind:string,start:long,end:long>>, "
                 "candidates array<struct<contexts:array<string>,value:string,start:long,end:long,seed:boolean>>")


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        bases, cands = [], []
        for text in pdf["text"]:
            text = text or ""
            base = base_spans(text)
            bases.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
            cands.append([{"contexts": c, "value": hashlib.blake2b(v.encode(), digest_size=16).hexdigest(),
                           "start": s, "end": e, "seed": z} for c, v, s, e, z in candidates(text, base)])
        yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "uid": pdf["uid"], "text_hash": pdf["text_hash"],
                            "base": bases,
                            "candidates": cands})


def score_patterns(edges: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT,
                   min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Confidence of each context over the graph of contexts and values.

    ``edges`` has (context, value, seed). In every round a context is as
    sure as its values, weighted by the different values it met:
    sum of value confidences / (values + 1); a value that is no seed is as
    sure as the surest context with enough support. Contexts that met
    ``min_support`` different sure values and reach ``min_confidence``
    pass. Sums and maxima are pre-aggregated before each shuffle.
    """
    edges = store(edges.groupBy("context", "value").agg(F.max(F.col("seed").cast("double")).alias("conf")),
                  "pii-graph")
    first = edges
    for _ in range(rounds):
        contexts = edges.groupBy("context").agg(
            (F.sum("conf") / (F.count("*") + 1)).alias("sure"),
            F.sum((F.col("conf") >= min_confidence).cast("long")).alias("support"))
        strong = contexts.filter((F.col("support") >= min_support) & (F.col("sure") >= min_confidence / 2))
        values = edges.join(strong, "context").groupBy("value").agg(F.max("sure").alias("via"))
        edges = store(first.join(values, "value", "left").select(
            "context", "value", F.greatest("conf", F.coalesce("via", F.lit(0.0))).alias("conf")), "pii-round")
    return (edges.groupBy("context").agg((F.sum("conf") / (F.count("*") + 1)).alias("sure"),
                                         F.sum((F.col("conf") >= min_confidence).cast("long")).alias("support"),
                                         F.count("*").alias("n"))
            .filter((F.col("support") >= min_support)
                    & (F.col("sure") * (F.col("n") + 1) / F.col("n") >= min_confidence)).select("context"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All spans of personal data: one row per document.

    Fixed patterns give the base spans (emails, IPs, cards, phones). Their
    values are the seeds: each stands in several lexical patterns (:func:`contexts`); patterns and the values they meet form a graph that
    :func:`score_patterns` scores iteratively; words with a digit behind a
    high-confidence pattern are added as spans of kind 'id', unless they
    overlap a base span. One pass reads the texts; graph and joins hold only
    contexts, value hashes and positions. A value repeated in copies of a
    document counts once, so a large group of copies gives no confidence.

    Null text: as empty, no spans. Long texts are read whole. Rows equal in
    id are told apart by row number and keep one result row each. Null ids
    are kept. Extra columns are ignored. No rows: no rows.

    Returns doc_id, uid, text_hash, base and found: arrays of (kind, start, end), code
    points, end exclusive, sorted by kind as listed and start.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.monotonically_increasing_id().alias("uid"), text_hash(F.col(text_col)).alias("text_hash"))
    return _with_found(store(rows.mapInPandas(_scan, _FOUND_SCHEMA), "pii-scan"))


def _with_found(scan: DataFrame) -> DataFrame:
    cands = (scan.select("uid", F.explode("candidates").alias("c"))
             .select("uid", "c.value", "c.start", "c.end", "c.seed", F.explode("c.contexts").alias("context")))
    passed = score_patterns(cands.select("context", "value", "seed"))
    extra = (cands.filter(~F.col("seed")).join(passed, "context", "left_semi").groupBy("uid")
             .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("s")))
    found = F.transform(F.coalesce("s", F.array().cast("array<struct<start:long,end:long>>")),
                        lambda x: F.struct(F.lit(FOUND).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return scan.join(extra, "uid", "left").select("doc_id", "uid", "text_hash", "base", found.alias("found"))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                  x["end"].cast("string"))), ",")


def op8_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    spans = find_pii(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return spans.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.concat("base", "found")).alias("spans"))


def _is(kind: str):
    return lambda x: x["kind"] == kind


def mask(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans are masked once, as the first."""
    if not text:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_all(text: pd.Series, found: pd.Series) -> pd.Series:
    """Texts with the spans of the fixed patterns and the given others masked, for use as a pandas UDF."""
    return pd.Series([mask(t, [*base_spans(t), *((s["kind"], s["start"], s["end"]) for s in
                                                 (f if f is not None else ()))]) if t else t
                      for t, f in zip(text, found, strict=True)], dtype=object)
