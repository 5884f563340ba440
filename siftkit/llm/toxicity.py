"""Operator 4: toxicity by a learned, weighted lexicon matched with Aho-Corasick over folded text."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, store, table

PER_CLASS = 8000         # bound of the labelled sample, rows a class
MAX_ENTRIES = 20000      # bound of the lexicon
MAX_PHRASES = 2000       # bound of the exception phrases
MIN_LOG_ODDS = 4.0
MIN_G2 = 25.0            # evidence (likelihood ratio) an entry needs
MIN_SHARE = 0.006        # of the toxic sample an entry must be in
MIN_CONTEXTS = 0.15      # different following words of an entry, per toxic text it is in (copies repeat theirs)
STEMS = (4, 5, 6)        # lengths of word beginnings tried besides whole words

# Letters of other alphabets that look like Latin ones, and the
# digits and signs written for letters. l, 1, ! and | all fold to i.
HOMOGLYPHS = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
              "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ո": "n", "α": "a", "ε": "e", "ο": "o",
              "ρ": "p", "τ": "t", "υ": "u", "ν": "v", "ι": "i", "κ": "k", "ı": "i", "ɡ": "g", "ⅼ": "i"}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
               "!": "i", "|": "i", "l": "i"}
BREAKS = ".,;:?\"'()[]{}<>«»“”„…\t\n\r\x0b\x0c#*%&=/\\"
ZERO_WIDTH = "​‌‍⁠﻿­"

_TABLE = str.maketrans({**HOMOGLYPHS, **SUBSTITUTES, **{c: " " for c in BREAKS}, **{c: None for c in ZERO_WIDTH},
                        **{chr(0xFF41 + k): SUBSTITUTES.get(chr(97 + k), chr(97 + k)) for k in range(26)}})


def fold(text: str | None) -> str:
    """Lower case, homoglyphs and substitutes folded, punctuation as spaces, one space at either end."""
    return f" {(text or '').lower().translate(_TABLE)} "


def _features(words: set[str]) -> set[str]:
    """Whole words (closed by a space) and word beginnings."""
    out = {w + " " for w in words if len(w) >= 3}
    for n in STEMS:
        out |= {w[:n] for w in words if len(w) >= n}
    return out


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pos, neg = Counter(), Counter()
        for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
            (pos if toxic else neg).update(_features(set(fold(text).split())))
        keys = list(pos.keys() | neg.keys())
        yield pd.DataFrame({"feature": keys, "pos": [pos[k] for k in keys], "neg": [neg[k] for k in keys]})


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)   # word beginning, or whole word closed by a space
    exceptions: list[str] = field(default_factory=list)       # phrases in which a match does not count
    model: tuple[float, float, float] = (-2.0, 1.0, 1.0)      # intercept, log of the sum, log of the density

    def automaton(self):
        import ahocorasick
        a = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            a.add_word(" " + entry, (len(entry) + 1, weight, entry))
        for phrase in self.exceptions:
            a.add_word(f" {phrase} ", (len(phrase) + 2, 0.0, phrase))
        if len(a):
            a.make_automaton()
        return a


def matches(automaton, folded: str) -> dict[int, tuple[float, str]]:
    """Start of each matched word with its highest weight and that entry; words inside an exception phrase are left out."""
    if not len(automaton):
        return {}
    found: dict[int, tuple[float, str]] = {}
    spared: list[tuple[int, int]] = []
    for end, (n, weight, entry) in automaton.iter(folded):
        start = end - n + 1
        if weight:
            found[start] = max((weight, entry), found.get(start, (0.0, "")))
        else:
            spared.append((start, end))
    for a, b in spared:
        for s in [s for s in found if a <= s < b]:
            del found[s]
    return found


def _measures(automaton, text: str | None) -> tuple[float, float]:
    folded = fold(text)
    total = sum(w for w, _ in matches(automaton, folded).values())
    words = folded.count(" ") or 1
    return math.log1p(total), math.log1p(100.0 * total / words)


def _choose(rows: list) -> dict[str, float]:
    """From (feature, log_odds): the shortest sure beginnings; a feature under a chosen one is dropped."""
    chosen: dict[str, float] = {}
    for feature, odds in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        if not any(feature[:n] in chosen for n in range(1, len(feature))):
            chosen[feature] = float(odds)
    return chosen


def _logistic(x, y, rounds: int = 50, ridge: float = 1e-3):
    """Newton's method for ridge logistic regression on a few measures."""
    import numpy as np
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) / len(y) - ridge * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta += step
        if abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id",
          text_col: str = "text") -> Lexicon:
    """Learn the lexicon, its exception phrases and the score from a bounded sample of labelled rows.

    The sample holds at most ``per_class`` rows of each class, those whose
    id hashes lowest. Only ids with crc32(id) mod 5 other than 0 take part.
    """
    import numpy as np
    spark = docs.sparkSession
    known = (labels.select(F.col(id_col).alias("__id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("__id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("__id")))
             .groupBy("__id").agg(F.max("toxic").alias("toxic")))
    picked = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("__id"), "__id").limit(per_class) for c in (0, 1)]
    sample = picked[0].unionByName(picked[1])
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    # the sample is at most 2 * per_class ids, so its broadcast is bounded by that parameter
    sample = store(rows.join(F.broadcast(sample), "__id"),
                   "toxic-sample").select("text", "toxic").dropDuplicates(["text"])
    sample = store(sample, "toxic-texts")
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_pos, n_neg = size.get(1, 0), size.get(0, 0)
    if not n_pos or not n_neg:
        return Lexicon()
    counts = sample.mapInPandas(_count, "feature string, pos long, neg long").groupBy("feature").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    rate = (F.col("pos") + F.col("neg")) / F.lit(n_pos + n_neg)
    odds = F.log((F.col("pos") + 0.5) / F.lit(n_pos + 1.0)) - F.log((F.col("neg") + 0.5) / F.lit(n_neg + 1.0))
    g2 = 2 * (F.col("pos") * F.log(F.greatest(F.col("pos"), F.lit(1e-9)) / (rate * n_pos))
              + F.when(F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / (rate * n_neg))).otherwise(0.0))
    entries = (counts.filter(F.col("pos") >= F.lit(max(1.0, MIN_SHARE * n_pos))).withColumns({"odds": odds, "g2": g2})
               .filter((F.col("odds") >= MIN_LOG_ODDS) & (F.col("g2") >= MIN_G2))
               .orderBy(F.col("g2").desc(), "feature").limit(MAX_ENTRIES).select("feature", "odds", "pos").collect())
    lexicon = Lexicon(weights=_choose([(r["feature"], r["odds"]) for r in entries]))

    def followers(batches):
        automaton = lexicon.automaton()
        for pdf in batches:
            out = set()
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                folded = fold(text) if toxic else ""
                out |= {(e, " ".join(folded[s:s + 120].split()[:2])) for s, (_, e) in matches(automaton, folded).items()}
            yield pd.DataFrame(sorted(out), columns=["feature", "phrase"])

    varied = {r["feature"]: r["n"] for r in sample.mapInPandas(followers, "feature string, phrase string")
              .groupBy("feature").agg(F.countDistinct("phrase").alias("n")).collect()}   # a row per entry at most
    in_texts = {r["feature"]: r["pos"] for r in entries}
    lexicon.weights = {e: w for e, w in lexicon.weights.items()
                       if varied.get(e, 0) >= max(2.0, MIN_CONTEXTS * in_texts[e])}

    def phrases(batches):
        automaton = lexicon.automaton()
        for pdf in batches:
            out = []
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                folded = fold(text)
                here = set()
                for s in matches(automaton, folded):
                    before, after = folded[max(0, s - 60):s].split()[-1:], folded[s:s + 120].split()[:2]
                    here |= {" ".join(after), " ".join(before + after[:1])}
                out += [(p, int(toxic)) for p in here if " " in p]
            yield pd.DataFrame(out, columns=["phrase", "toxic"])

    mild = (sample.mapInPandas(phrases, "phrase string, toxic int").groupBy("phrase")
            .agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
            .filter((F.col("neg") >= 3) & (F.col("neg") / F.lit(n_neg) > 9 * F.col("pos") / F.lit(n_pos)))
            .orderBy(F.col("neg").desc(), "phrase").limit(MAX_PHRASES).collect())
    lexicon.exceptions = sorted(r["phrase"] for r in mild)

    def measured(batches):
        automaton = lexicon.automaton()
        for pdf in batches:
            yield pd.DataFrame([(*_measures(automaton, t), int(y)) for t, y in
                                zip(pdf["text"], pdf["toxic"], strict=True)], columns=["a", "b", "y"])

    fit = sample.mapInPandas(measured, "a double, b double, y int").toPandas()  # 2 * per_class rows at most
    weight = np.where(fit["y"] == 1, n_neg / n_pos, 1.0)   # the classes count alike
    fit = fit.loc[fit.index.repeat(np.maximum(1, np.round(weight)).astype(int))]
    lexicon.model = _logistic(fit[["a", "b"]].to_numpy(float), fit["y"].to_numpy(float))
    return lexicon


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text with ``lexicon``.

    The text is folded (case, homoglyphs, digits and signs for letters), the
    weights of all lexicon words found by the automaton are summed, except
    inside exception phrases, and the sum and its density per hundred words
    go into a logistic score. Null and empty texts get the score of a text
    without matches. Each row is scored by itself: repeated rows, ties and
    null ids give one result row each. Extra columns are ignored.

    Returns doc_id, held_out, score, predicted, n_matches.
    """
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        c, wa, wb = lexicon.model
        for pdf in batches:
            scores, found = [], []
            for text in pdf["text"]:
                folded = fold(text)
                hits = matches(automaton, folded)
                total = sum(w for w, _ in hits.values())
                z = c + wa * math.log1p(total) + wb * math.log1p(100.0 * total / (folded.count(" ") or 1))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                found.append(len(hits))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": scores, "n_matches": found})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = rows.mapInPandas(scored, "doc_id long, score double, n_matches long")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_matches")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, learn(docs, table(spark, sf_dir, "labels")))
