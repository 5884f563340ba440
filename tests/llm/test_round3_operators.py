"""Whitening, importance resampling and content sort against brute force, with their edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftkit.llm import exactdup, resampling, whitening
from siftkit.llm.common import prepare
from siftkit.llm.spectra import Spectrum, rank_one, secular_roots
from tests.conftest import plan_text

LONG = "word " * 40000 + "end"


@pytest.fixture(scope="module")
def spark(spark):
    return prepare(spark)


# ------------------------------------------------------------------ 13: content sort
CLASH = "doc_id long, text string, keep_id long, kept boolean, t string, h long, salt int, p string"


def contents(spark, rows):
    return spark.createDataFrame([(i, t, 7, True, "t", 1, 2, "p") for i, t in rows], CLASH).repartition(5)


def classes(rows):
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in by.items()}


ROWS = ([(i, "hot copy of one text") for i in range(300)] + [(1000 + i, f"unique {i}") for i in range(100)]
        + [(2000, None), (2001, ""), (2002, " "), (2003, LONG), (2004, LONG), (2005, LONG + "."), (2006, "Case"),
           (2007, "case"), (2008, "é"), (2009, "é")])


@pytest.mark.parametrize("hot_rows", [8, 1000])
def test_content_sort_equals_grouping(spark, hot_rows):
    want = classes(ROWS)
    got = exactdup.exact_duplicates(contents(spark, ROWS), hot_rows=hot_rows).collect()
    texts = dict(ROWS)
    assert len(got) == len(ROWS)
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert (r["keep_id"], r["group_size"]) == want[text]
        assert r["kept"] == (r["doc_id"] == r["keep_id"])
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("hot_rows", [4, 1000])
def test_content_sort_of_repeated_and_null_ids(spark, hot_rows):
    rows = [(5, "a")] * 9 + [(None, "a")] * 9 + [(None, "b")] * 9 + [(1, "c"), (None, "c")]
    got = exactdup.exact_duplicates(contents(spark, rows), hot_rows=hot_rows).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r["text_sha256"]].append(r)
    for text, keep, size in (("a", 5, 18), ("b", None, 9), ("c", 1, 2)):
        group = by[hashlib.sha256(text.encode()).hexdigest()]
        assert {(r["keep_id"], r["group_size"]) for r in group} == {(keep, size)}
        assert [r["doc_id"] for r in group if r["kept"]] == [keep]


def test_content_sort_smallest_id_and_normaliser(spark):
    from pyspark.sql import functions as F
    got = exactdup.exact_duplicates(contents(spark, [(3, "A"), (1, "a"), (2, "b"), (4, None)]), keep="min",
                                    normalise=lambda c: F.nullif(F.lower(c), F.lit("b"))).collect()
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in got} == {
        1: (1, True), 3: (1, False), 2: (2, True), 4: (2, False)}
    with pytest.raises(ValueError):
        exactdup.exact_duplicates(contents(spark, [(1, "a")]), keep="any")


def test_content_sort_of_nothing_and_its_plan(spark, monkeypatch):
    empty = contents(spark, [(1, "a")]).limit(0)
    out = exactdup.exact_duplicates(empty)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and out.count() == 0
    plans = {}
    real = exactdup.store
    monkeypatch.setattr(exactdup, "store", lambda df, name: plans.setdefault(name, plan_text(df)) and real(df, name))
    plans["out"] = plan_text(exactdup.exact_duplicates(contents(spark, ROWS)))
    whole = "\n".join(plans.values())
    assert not any(n in whole for n in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"))
    assert plans["exact-runs"].count("rangepartitioning(") >= 1
    assert "rangepartitioning(p" in plans["exact-runs"]


# ------------------------------------------------------------------ 12: importance resampling
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow_features(text, max_run):
    w = slow_words(text)
    return Counter(" ".join(w[i:i + k]) for k in range(1, max_run + 1) for i in range(len(w) - k + 1))


def slow_draw(docs, target, max_run, buckets, min_words, pct, seed):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets
    found = [slow_features(t, max_run) for _, t in docs]
    s, t = Counter(), Counter()
    for f in found:
        for k, n in f.items():
            s[bucket(k)] += n
    for text in target:
        for k, n in slow_features(text, max_run).items():
            t[bucket(k)] += n
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for (i, text), f in zip(docs, found, strict=True):
        gains = sum(n * math.floor(1000 * math.log((t[bucket(k)] + 1) * (s_all + buckets)
                                                   / ((s[bucket(k)] + 1) * (t_all + buckets)))) for k, n in f.items())
        n = sum(f.values())
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        weight = gains // n if n else 0
        out.append([i, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))),
                    len(slow_words(text)), None])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(able[:pct * len(able) // 100]):
        r[5] = k + 1
    return {r[0]: (r[1], r[2], r[3], r[5]) for r in out}


@given(st.text(alphabet="aZ9 _\n\x00é漢́.-", max_size=60))
@settings(max_examples=60, deadline=None)
def test_words_and_offset_windows(text):
    low = resampling.lowered(text)
    found = resampling.words(low)
    assert [w for w, _ in found] == slow_words(text)
    assert all(low[a:b] == w for w, (a, b) in found)
    assert Counter(resampling.runs(low, found, 3)) == slow_features(text, 3)


@pytest.mark.parametrize("max_run", [1, 3])
def test_resampling_equals_brute_force(spark, max_run):
    docs = [(i, f"Alpha beta {i % 7} gamma, delta-{i % 5}  Été " * (1 + i % 9)) for i in range(120)]
    docs += [(500, None), (501, ""), (502, " .,;\x00"), (503, LONG), (504, "x" * 200000), (505, " " * 200000)]
    target = ["beta gamma delta", None, "", "gamma 3 delta"]
    frame = spark.createDataFrame([(i, t, 1, 2, [1], 9) for i, t in docs],
                                  "doc_id long, text string, score long, rank long, bucket array<int>, idx long")
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "doc_id long, text string")
    got = resampling.importance_resample(frame.repartition(4), goal, max_run=max_run, buckets=500, draw_pct=30).collect()
    want = slow_draw(docs, target, max_run, 500, 20, 30, 2024)
    assert {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in got} == want


def test_resampling_of_nothing_and_odd_ids(spark):
    schema = "doc_id long, text string"
    none = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(None, "a b c"), (1, "a b"), (1, "a b")], schema)
    assert resampling.importance_resample(none, one).collect() == []
    got = resampling.importance_resample(one, none, min_words=2, draw_pct=100).collect()
    assert sorted(r["rank"] for r in got) == [1, 2, 3]
    assert len({(r["weight"], r["score"]) for r in got if r["doc_id"] == 1}) == 1
    assert resampling.noise(None, 3) == resampling.noise(None, 3)


# ------------------------------------------------------------------ 11: whitening
@given(st.integers(1, 9), st.integers(0, 10 ** 6))
@settings(max_examples=60, deadline=None)
def test_secular_roots_interlace_and_solve(k, seed):
    rng = np.random.default_rng(seed)
    d = np.sort(rng.random(k)) * 10.0 ** rng.integers(-3, 4) + np.arange(k) * 1e-6
    w = rng.random(k) * 10.0 ** rng.integers(-6, 3, k)
    roots, gap = secular_roots(d, w)
    want = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(w), np.sqrt(w)))
    assert np.allclose(roots, want, rtol=0, atol=1e-12 * max(1.0, np.abs(want).max()))
    assert (roots >= d).all() and (gap[np.arange(k), np.arange(k)] <= 0).all()


@given(st.integers(1, 8), st.integers(0, 40), st.integers(0, 10 ** 6), st.sampled_from(["normal", "small", "copies", "line"]))
@settings(max_examples=60, deadline=None)
def test_rank_one_updates_keep_the_scatter(dim, n, seed, kind):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * 100
    if kind == "small":
        x = rng.integers(-1, 2, (n, dim)).astype(float)                 # many equal eigenvalues
    elif kind == "copies":
        x[n // 3:] = x[:1] if n else 0
    elif kind == "line" and n:
        x = np.outer(np.arange(n), rng.integers(1, 4, dim)).astype(float)
    one, blocks, left, right = (Spectrum.empty(dim) for _ in range(4))
    for row in x:
        one.add(row)
    blocks.add_block(x)
    left.add_block(x[:n // 2])
    right.add_block(x[n // 2:])
    left.combine(Spectrum.unpack(right.pack()))
    centred = x - x.mean(axis=0) if n else x
    want = centred.T @ centred
    size = max(1.0, np.abs(want).max())
    for state in (one, blocks, left):
        assert state.n == n
        assert np.abs(state.vectors @ np.diag(state.values) @ state.vectors.T - want).max() <= 1e-11 * size
        r = state.vectors.shape[1]
        assert np.abs(state.vectors.T @ state.vectors - np.eye(r)).max(initial=0) < 1e-11


def test_rank_one_without_change():
    values, vectors = rank_one(np.zeros(0), np.zeros((3, 0)), np.zeros(3))
    assert values.shape == (0,) and vectors.shape == (3, 0)


VEC = "vec_id long, embedding array<float>, x array<long>, n long, component int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, [1], 5, 6) for i, v in rows], VEC).repartition(6)


def check_whitening(rows, got, tolerance=1e-9):
    """Against a plain eigendecomposition; returns the rows by id."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max(len(v) for _, v in kept)
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (dim - len(v)) for _, v in kept])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:4], q[:, ::-1][:, :4]
    assert len(got) == len(kept) * len(e)
    by = defaultdict(dict)
    for r in got:
        by[r["vec_id"]][r["component"]] = r
    for k in range(len(e)):
        have = np.array([by[i][k + 1]["whitened"] for i, _ in kept], dtype=float)
        want = (x - s / n) @ q[:, k] / np.sqrt(e[k])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < tolerance
    for (i, _), row in zip(kept, x, strict=True):
        assert {r["deviation"] for r in by[i].values()} == {int(((n * row - s) ** 2).sum())}
        assert {r["n"] for r in by[i].values()} == {n}
        for k in range(len(e)):
            assert abs(by[i][k + 1]["explained"] - e[k] / (centred ** 2).sum() * n) < 1e-9
            assert by[i][k + 1]["identity_error"] < 1e-9
    return by


@pytest.mark.parametrize("block", [1, 16, None])
def test_whitening_equals_a_plain_eigendecomposition(spark, block):
    rng = np.random.default_rng(5)
    spread = np.array([9, 7, 5, 4, 2, 1, 1, 0.5])
    rows = [(i, (rng.standard_normal(8) * spread).tolist()) for i in range(300)]
    rows += [(1000 + k, rows[0][1]) for k in range(150)]                  # one vector holds a third of the rows
    rows += [(2000, None), (2001, [1.0, None] * 4), (2002, [float("nan")] * 8), (2003, [float("-inf")] * 8),
             (2004, []), (2005, [1.0, -0.0]), (2006, [-0.0] * 8)]
    check_whitening(rows, whitening.whiten(vectors(spark, rows), block=block).collect())


def test_whitening_without_spread_and_of_nothing(spark):
    assert whitening.whiten(vectors(spark, [(1, [1.0])]).limit(0)).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).collect() == []
    got = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(got) == 6 and {r["n"] for r in got} == {1} and {r["whitened"] for r in got} == {None}
    assert {r["deviation"] for r in got} == {0} and {r["identity_error"] for r in got} == {None}
    two = whitening.whiten(vectors(spark, [(1, [1.0, 2.0, 0.0]), (2, [3.0, 1.0, 0.0])])).collect()
    first = {r["vec_id"]: r["whitened"] for r in two if r["component"] == 1}
    assert sorted(round(v, 9) for v in first.values()) == [-1.0, 1.0]
    assert {r["whitened"] for r in two if r["component"] > 1} == {None}


def test_deviation_beyond_a_long_is_null(spark):
    got = whitening.whiten(vectors(spark, [(1, [3.0e7, 0.0]), (2, [-3.0e7, 1.0]), (3, [0.0, 0.0])])).collect()
    n, xs = 3, {1: (7680000000, 0), 2: (-7680000000, 256), 3: (0, 0)}
    s = [sum(x[d] for x in xs.values()) for d in (0, 1)]
    for r in got:
        exact = sum((n * x - t) ** 2 for x, t in zip(xs[r["vec_id"]], s, strict=True))
        assert r["deviation"] == (exact if exact < 1 << 63 else None)
