"""The segment join finds exactly the brute-force matches."""

from conftest import plan_text
import random

import pytest
from pyspark.sql import functions as F

from siftkit.operators.segments import _without, own_segments, probe_segments, segment_candidates
from siftkit.operators.similarity import best_match, similarity_candidates, step_threshold


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def _words(rng, n, alphabet="abc ", lo=0, hi=10):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(lo, hi))) for _ in range(n)]


def test_candidates_equal_brute_force(spark):
    rng = random.Random(7)
    queries = sorted(set(_words(rng, 120)))
    values = _words(rng, 150) + ["", "a", "ab"]
    thr = step_threshold(7, 2)
    q = spark.createDataFrame([(w, w) for w in queries], "k string, t string")
    d = spark.createDataFrame([(v,) for v in values], "v string")
    got = {(r.k, r.v, r.distance) for r in similarity_candidates(q, "k", "t", d, "v", thr).collect()}
    want = set()
    for w in queries:
        t = 1 if len(w) <= 7 else 2
        for v in set(values):
            if w[:1] == v[:1] and abs(len(w) - len(v)) <= 2 and _lev(w, v) <= t:
                want.add((w, v, _lev(w, v)))
    assert got == want


def test_best_match_breaks_ties_by_value(spark):
    q = spark.createDataFrame([("k", "abcd")], "k string, t string")
    d = spark.createDataFrame([("abce",), ("abcf",), ("abxd",)], "v string")
    cand = similarity_candidates(q, "k", "t", d, "v", step_threshold(7, 2))
    assert best_match(cand, "k", "v", "m").collect()[0].m == "abce"


@pytest.mark.parametrize("k", [0, 1, 2, 3, 4])
@pytest.mark.parametrize("same_first", [True, False])
def test_segment_join_equals_brute_force_at_any_distance(spark, k, same_first):
    rng = random.Random(k)
    queries, values = (_words(rng, 90, alphabet="abé ") for _ in range(2))
    base = "".join(rng.choice("abcdefgh") for _ in range(250))             # long strings, 0 to 5 edits apart
    for edits in range(6):
        s = list(base)
        for _ in range(edits):
            at = rng.randrange(1, len(s))
            s[at:at + 1] = rng.choice(["", "x", "yz"])
        (queries if edits % 2 else values).append("".join(s))
    q = spark.createDataFrame([*enumerate(queries), (-1, None)], "k long, t string")
    d = spark.createDataFrame([(v,) for v in [*values, *values[:9], None]], "v string")
    got = [tuple(r) for r in segment_candidates(q, "k", "t", d, "v", lambda n: F.lit(k), k, k, same_first).collect()]
    want = {(i, v, _lev(t, v)) for i, t in enumerate(queries) for v in values
            if abs(len(t) - len(v)) <= k and (not same_first or t[:1] == v[:1]) and _lev(t, v) <= k}
    assert len(got) == len(set(got)) and set(got) == want


def test_segment_keys_stay_few_and_cover_the_string(spark):
    df = spark.createDataFrame([("x" * 7 + "".join(chr(97 + i % 26) for i in range(n)),) for n in (0, 1, 5, 250)], "s string")
    n, k = F.length("s"), F.lit(3)
    for r in df.select("s", own_segments(F.col("s"), n, k).alias("own"), probe_segments(F.col("s"), n, k, 3).alias("p")).collect():
        assert "".join(x["piece"] for x in r["own"]) == r["s"] and len(r["own"]) == 4
        assert len(r["p"]) <= 7 * 16
    many = df.select(F.size(_without(F.col("s"), n, F.lit(2))).alias("c"), n.alias("n")).collect()
    assert all(r["c"] <= 1 + r["n"] + r["n"] * (r["n"] - 1) // 2 for r in many)


def test_strings_around_the_short_limit(spark):
    rng = random.Random(9)
    values = ["".join(rng.choice("ab") for _ in range(n)) for n in (21, 22, 23, 24, 25, 26, 27) for _ in range(12)]
    queries = []
    for v in values:
        s = list(v)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(s))
            s[at:at + 1] = rng.choice(["", "c", "ab", "b"])
        queries.append("".join(s))
    q = spark.createDataFrame([*enumerate(queries)], "k long, t string")
    d = spark.createDataFrame([(v,) for v in values], "v string")
    got = {tuple(r) for r in similarity_candidates(q, "k", "t", d, "v", step_threshold(7, 2)).collect()}
    assert got == {(i, v, _lev(t, v)) for i, t in enumerate(queries) for v in values
                   if t[:1] == v[:1] and abs(len(t) - len(v)) <= 2 and _lev(t, v) <= 2}


def test_tagged_dictionaries_in_one_join(spark):
    q = spark.createDataFrame([("a", 1, "abcdefgh"), ("b", 1, "abcdefgh"), ("c", 1, "abcdefgh")], "g string, k long, t string")
    d = spark.createDataFrame([("a", "abcdefgx"), ("b", "abcdefxx"), ("b", "zzz")], "g string, v string")
    got = similarity_candidates(q, "k", "t", d, "v", step_threshold(7, 2), tags=("g",)).collect()
    assert sorted(map(tuple, got)) == [("a", 1, "abcdefgx", 1), ("b", 1, "abcdefxx", 2)]


def test_no_nested_loop_join(spark):
    q = spark.createDataFrame([("k", "abcd")], "k string, t string")
    d = spark.createDataFrame([("abce",)], "v string")
    plan = plan_text(similarity_candidates(q, "k", "t", d, "v", step_threshold(7, 2)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
