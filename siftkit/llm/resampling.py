"""Operator 12: importance resampling of documents towards a target corpus."""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import global_order, prepare, store, table

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"   # characters between words of the lowered text
MAX_RUN = 1              # words in the longest feature
BUCKETS = 10_000
MIN_WORDS = 20           # documents with fewer words are scored, never drawn
DRAW_PCT = 10
SEED = 2024
SCALE = 1000             # gains and scores are floored thousandths
FEATURES = "n_words long, n_features long, bucket array<int>, times array<long>"


@functools.lru_cache(maxsize=1)
def _splitter():
    """The pre-tokeniser: a regex split, no vocabulary and no training."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split
    return Split(Regex(GAPS), behavior="removed")


def lowered(text: str | None) -> str:
    """A-Z to a-z and nothing else (bytes methods touch ASCII letters only)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words(text: str) -> list[tuple[str, tuple[int, int]]]:
    """Words of a lowered text with their (start, end) places, in code points."""
    return _splitter().pre_tokenize_str(text)


def runs(text: str, found: list[tuple[str, tuple[int, int]]], max_run: int) -> Iterator[str]:
    """Runs of 1 to ``max_run`` consecutive words, joined by one space.

    A longer run is a window over the offset pairs: from the start of its
    first word to the end of its last. Where one space stands in each gap the window's text is
    the feature itself; otherwise its words are joined.
    """
    for word, _ in found:
        yield word
    if max_run < 2 or len(found) < 2:
        return
    odd = [0]                                                     # gaps so far that are not one space
    for (_, (_, end)), (_, (start, _)) in zip(found, found[1:], strict=False):
        odd.append(odd[-1] + (text[end:start] != " "))
    for width in range(2, max_run + 1):
        for i in range(len(found) - width + 1):
            j = i + width - 1
            if odd[i] == odd[j]:
                yield text[found[i][1][0]:found[j][1][1]]
            else:
                yield " ".join(w for w, _ in found[i:j + 1])


def _features(max_run: int, buckets: int):
    """doc_id and counts by bucket of each text; other columns are left behind."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n_words, n_features, where, times = [], [], [], []
            for text in pdf["text"]:
                text = lowered(text)
                found = words(text)
                seen = Counter(runs(text, found, max_run))
                hits: Counter = Counter()
                for feature, n in seen.items():
                    hits[zlib.crc32(feature.encode("utf-8", "surrogatepass")) % buckets] += n
                n_words.append(len(found))
                n_features.append(sum(hits.values()))
                where.append(list(hits))
                times.append(list(hits.values()))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": n_words, "n_features": n_features,
                                "bucket": where, "times": times})
    return run


def bucket_features(texts: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS, id_col: str | None = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and the sparse bucket counts of every whole text."""
    ident = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    return texts.select(ident.alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        _features(max_run, buckets), f"doc_id long, {FEATURES}")


def histogram(features: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Features in each bucket over all rows: at most ``buckets`` numbers reach the driver, at any input size."""
    counted = (features.select(F.inline(F.arrays_zip("bucket", "times"))).groupBy("bucket")
               .agg(F.sum("times").alias("n")))
    out = [0] * buckets
    for r in counted.collect():
        out[r["bucket"]] = int(r["n"])
    return out


def bucket_gains(source: list[int], target: list[int]) -> list[int]:
    """Floored thousandths of the log ratio of smoothed target and source shares, for each bucket."""
    buckets, s_all, t_all = len(source), sum(source), sum(target)
    return [math.floor(SCALE * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
            for s, t in zip(source, target, strict=True)]


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of an id, in floored thousandths; a null id is written ``null``."""
    name = "null" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def _scores(gains: list[int], seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        table_ = np.asarray(gains, dtype=np.int64)
        for pdf in batches:
            weight = [int(table_[np.asarray(b, dtype=np.int64)] @ np.asarray(t, dtype=np.int64)) // int(n) if n else 0
                      for b, t, n in zip(pdf["bucket"], pdf["times"], pdf["n_features"], strict=True)]
            ids = [None if pd.isna(i) else int(i) for i in pdf["doc_id"]]
            score = [w + noise(i, seed) for w, i in zip(weight, ids, strict=True)]
            yield pd.DataFrame({"doc_id": pd.Series(ids, dtype="Int64"), "n_words": pdf["n_words"],
                                "n_features": pdf["n_features"], "weight": pd.Series(weight, dtype="int64"),
                                "score": pd.Series(score, dtype="int64")})
    return run


def importance_resample(docs: DataFrame, target: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS,
                        min_words: int = MIN_WORDS, draw_pct: int = DRAW_PCT, seed: int = SEED,
                        id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """Weigh documents by how much likelier their features are in ``target``, and draw a share of them.

    Texts are lowered (A-Z only) and cut by a regex pre-tokeniser; runs of 1 to ``max_run``
    words are hashed by CRC-32 into ``buckets``. Both corpora are counted by
    bucket over all rows, in partial sums before a shuffle of bucket numbers; only the fixed
    number of bucket counts reaches the driver. A bucket's gain is the log ratio of the
    smoothed shares, a document's weight the floored mean gain of its
    features. Weight plus Gumbel noise of the id is the score: the highest
    scores are a draw without replacement. Ranks come from a
    global range order of narrow rows, not from a window over all rows. Texts are read
    once and never shuffled.

    Null and empty texts: no words, weight 0, never drawn. Null ids: noise of
    the name ``null``, last among equal scores. Repeated rows are scored and drawn each
    for itself. No documents: no rows; no target rows: gains from the smoothing alone. Extra
    columns, also of the names used here, are ignored.

    Returns doc_id, n_features, weight, score, rank (null if not drawn).
    """
    found = store(bucket_features(docs, max_run, buckets, id_col, text_col), "resample-features")
    gains = bucket_gains(histogram(found, buckets),
                         histogram(bucket_features(target, max_run, buckets, None, target_text), buckets))
    scored = store(found.mapInPandas(_scores(gains, seed), "doc_id long, n_words long, n_features long, weight long, "
                                                           "score long"), "resample-scores")
    able = scored.filter(F.col("n_words") >= min_words)
    draw = draw_pct * able.count() // 100
    ordered = global_order(able.withColumn("low", -F.col("score")), ["low", "doc_id"], [], "resample-rank")
    rank = F.when(F.col("idx") < draw, F.col("idx") + 1).cast("long").alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    return ordered.select(*columns, rank).unionByName(
        scored.filter(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank")))


def op12_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
