"""N12 + W2: the closest value by edit keys is the brute-force one, and its work follows the rows, not the pairs."""

import random

import pytest
from pyspark.sql import functions as F

from siftkit.operators.nearest import KEY, edit_keys
from siftkit.operators.segments import segment_candidates
from siftkit.operators.similarity import best_match, similarity_candidates, step_threshold
from test_similarity import _lev, _words


def _wanted(queries, values, limit, gap, same_first=True):
    best = {}
    for i, t in queries:
        near = [(_lev(t, v), v) for v in values if v is not None and abs(len(t) - len(v)) <= gap
                and (not same_first or t[:1] == v[:1])]
        near = [x for x in near if x[0] <= limit(len(t))]
        if near:
            best[i] = min(near)[1]
    return best


@pytest.mark.parametrize("limit,gap,same_first", [(0, 0, True), (1, 1, True), (2, 2, True), (2, 1, True), (2, 2, False), (2, 0, True),
                                                  (3, 3, True)])
def test_nearest_equals_brute_force(spark, limit, gap, same_first):
    rng = random.Random(limit * 10 + gap)
    values = [*_words(rng, 120, alphabet="abé "), *["".join(rng.choice("ab") for _ in range(n)) for n in range(21, 28) for _ in range(4)],
              "", "a", None]
    queries = [*_words(rng, 120, alphabet="abé "), ""]
    for v in values[-30:-3]:
        s = list(v)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(s))
            s[at:at + 1] = rng.choice(["", "c", "ab", "b"])
        queries.append("".join(s))
    q = spark.createDataFrame([*enumerate(queries), (-1, None)], "k long, t string")
    d = spark.createDataFrame([(v,) for v in values], "v string")
    cand = segment_candidates(q, "k", "t", d, "v", lambda n: F.lit(limit), gap, limit, same_first, nearest=True)
    got = {r.k: r.m for r in best_match(cand, "k", "v", "m").collect()}
    assert got == _wanted([*enumerate(queries)], values, lambda n: limit, gap, same_first)


def test_nearest_by_step_threshold_and_tags(spark):
    rng = random.Random(4)
    queries, values = [*enumerate(_words(rng, 150, lo=4, hi=11))], _words(rng, 80, lo=4, hi=11)
    q = spark.createDataFrame([(g, i, t) for g in "xy" for i, t in queries], "g string, k long, t string")
    d = spark.createDataFrame([("x", v) for v in values[:40]] + [("y", v) for v in values[40:]], "g string, v string")
    got = similarity_candidates(q, "k", "t", d, "v", step_threshold(7, 2), tags=("g",), nearest=True)
    for g, part in (("x", values[:40]), ("y", values[40:])):
        best = {r.k: r.m for r in best_match(got.where(F.col("g") == g), "k", "v", "m").collect()}
        assert best == _wanted(queries, part, lambda n: 1 if n <= 7 else 2, 2)


def test_keys_hold_a_place_beside_any_character(spark):
    """A substituted character is a place of the key, so no character of the strings can stand for it."""
    df = spark.createDataFrame([("x￿z", "￿yz"), ("x\x00z", "\x00yz")], "a string, b string")
    keys = [edit_keys(F.col(c), F.length(c), ((1, 0, 0),), of) for c, of in (("a", False), ("b", True))]
    assert all(r.n == 0 for r in df.select(F.size(F.array_intersect(*keys)).alias("n")).collect())
    assert [f for f in df.select(F.explode(keys[0]).alias("k")).schema["k"].dataType.names] == list(KEY)


def test_numbered_names_give_no_pairs(spark):
    """A thousand names that differ in three digits: a row a query at most, where all pairs within reach were 200 a query."""
    d = spark.range(1000).select(F.format_string("supplier %09d", "id").alias("v"))
    q = spark.range(1000).select("id", F.format_string("supplier %08dx", "id").alias("t"))
    got = similarity_candidates(q, "id", "t", d, "v", step_threshold(7, 2), nearest=True).collect()
    assert len(got) == len({r.id for r in got}) == 1000
    assert all(r.distance == 1 and r.v == f"supplier {r.id * 10:09d}" for r in got if r.id < 100)
