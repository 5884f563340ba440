"""The stages of the corpus pipeline against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from siftkit.llm import mixing, neardup, packing, pii
from siftkit.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def spark(spark):
    return prepare(spark)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], DOCS).repartition(3)


def _long_sources():
    """Source s01 (weight 1) holds a fifth of the words, in long documents: its target is far below half its size."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        source = f"s{i % 20:02}"
        n = rng.randrange(1000, 3000) if source == "s01" else rng.choice([3, 40, 70, 500, 1200])
        rows.append((i, " ".join(f"w{k}" for k in range(n)), source))
    return rows


def test_mixing_takes_what_is_allotted_at_any_length(spark):
    rows = _long_sources()
    plan = {r["source"]: r for r in mixing.mix_sources(frame(spark, rows)).collect()}
    copies = Counter(r["doc_id"] for r in corpus_pipeline.mixing(spark, frame(spark, rows), "").collect())
    assert max(copies.values()) <= mixing.MAX_REPEATS
    size = {i: len(t.split()) for i, t, _ in rows}
    for s, r in plan.items():
        mine = [i for i, _, of in rows if of == s]
        allotted = min(sum(r["quotas"]) * mixing.BLOCK, mixing.MAX_REPEATS * r["source_size"])
        taken = sum(size[i] * copies[i] for i in mine)
        assert 2 * abs(taken - allotted) <= max(size[i] for i in mine)
        assert abs(allotted - r["target"]) <= 2 * mixing.BLOCK
        # every pass goes over all documents before one is taken again
        assert max(copies[i] for i in mine) - min(copies[i] for i in mine) <= 1
    assert plan["s01"]["target"] < 0.5 * plan["s01"]["source_size"]


def test_whole_documents_follow_the_draw(spark):
    rows = [(r["doc_id"], r["size"], r["source"], r["quota"], r["copies"]) for r in mixing.mix_documents(
        frame(spark, [*_long_sources(), (900, "", "s00"), (901, " \n", "t")])).collect()]
    assert {r[0] for r in rows if not r[1]} == {900, 901} and not any(r[4] for r in rows if not r[1])
    for s in ("s00", "s01", "s02"):
        mine = [r for r in rows if r[2] == s and r[1]]
        total, most = sum(r[1] for r in mine), max(r[4] for r in mine)
        at_most = sum(r[1] for r in mine if r[4] == most) + (most - 1) * total
        assert 2 * abs(at_most - mine[0][3]) <= max(r[1] for r in mine)
    assert mixing.mix_documents(frame(spark, [(1, "a", "a")]).limit(0)).count() == 0


def test_stages_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for g in range(30):
        base = [f"g{g}x{rng.randrange(10 ** 6)}" for _ in range(60)]
        for _ in range(3):
            words = list(base)
            for _ in range(rng.choice([0, 1, 12])):
                words[rng.randrange(60)] = f"e{rng.randrange(10 ** 6)}"
            mail = f" Write to user{len(rows)}@mail.example.com today" if rng.random() < 0.3 else ""
            rows.append((len(rows), " ".join(words) + mail + ".", "ab"[g % 2]))
    junk = [(500, "too short", "a"), (501, " ".join(["again and"] * 60) + ".", "b")]
    menu = "\nHome | About | News | Shop | Help | More | Us"
    docs = frame(spark, [*((i, t + menu * (i % 4 == 0), s) for i, t, s in rows), *junk])

    docs = corpus_pipeline.quality(spark, docs, "")
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in docs.collect()) == [(i, t, len(t)) for i, t, _ in rows]

    sets = [neardup.shingle_set(t.split(), 5) for _, t, _ in rows]
    parent = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                old, new = max(parent[a], parent[b]), min(parent[a], parent[b])
                parent = [new if p == old else p for p in parent]
    docs = corpus_pipeline.near_dedup(spark, docs, "")
    kept = sorted(r["doc_id"] for r in docs.collect())
    assert kept == sorted(set(parent)) and len(kept) < len(rows)

    docs = corpus_pipeline.pii(spark, docs, "")
    want = {i: pii.mask(t, pii.base_spans(t)) for i, t, _ in rows if i in kept}
    masked = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert masked == want and any("[EMAIL]" in t for t in want.values())
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())

    docs = corpus_pipeline.mixing(spark, docs, "")
    copies = Counter(r["doc_id"] for r in docs.collect())
    assert set(copies) <= set(kept) and all(r["text"] == want[r["doc_id"]] for r in docs.collect())

    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.packing(spark, docs, "").collect():
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for i, n in copies.items():
        ids = [*packing.encode(want[i]).tolist(), packing.END]
        crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))
        assert [(r["start"], r["length"], r["ids_crc32"]) for r in by_doc[i]] == [(0, len(ids), crc)] * n
    assert set(by_doc) == set(copies)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.LIMIT


ODD_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, size string, "
              "copies string, uid string, base string, n_words string")


def odd(spark):
    """Nulls in every column, copies, rows equal in id and text, one id with two texts, names the operators use."""
    body = " ".join(f"word{k}" for k in range(60)) + " and mail to some.one@mail.example.com today."
    other = " ".join(f"other{k}" for k in range(60)) + "."
    extra = ("mine", "s", "c", "u", "b", "w")
    rows = [(1, body, "en", "a", len(body)), (1, body, "en", "a", len(body)), (1, other, None, None, len(other)),
            (2, body, "en", "b", None), (None, other + " more", "en", None, 9), (None, None, None, None, None),
            (3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, " \n ", "en", "b", 3),
            (6, "x " * 50000 + other, "en", "b", 7)]
    return spark.createDataFrame([r + extra for r in rows], ODD_SCHEMA).repartition(3), extra


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_rows_and_on_none(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs, extra = odd(spark)
    before = docs.collect()
    out = stage(spark, docs, "")
    got = out.collect()
    assert stage(spark, docs.limit(0), "").collect() == []
    if name == "packing":
        assert Counter(r["doc_id"] for r in got if r["piece"] == 0) == Counter(r["doc_id"] for r in before)
        return
    assert out.schema == docs.schema
    assert all(tuple(r)[5:] == extra for r in got)                        # clashing columns come back untouched
    ids = Counter((r["doc_id"], r["source"]) for r in got)
    if name == "quality":
        assert ids == Counter({(1, "a"): 2, (1, None): 1, (2, "b"): 1, (None, None): 1})
    if name == "near_dedup":                                              # of the two classes the smallest id; null ids last
        assert ids == Counter({(1, "a"): 1, (1, None): 1, (None, None): 1, (3, "a"): 1, (4, "a"): 1, (5, "b"): 1})
        # row 6 holds the shingles of the other text and five more, so it is one of its class
    if name == "pii":
        assert ids == Counter((r["doc_id"], r["source"]) for r in before)
        assert sum("[EMAIL]" in (r["text"] or "") for r in got) == 3 and not any("@" in (r["text"] or "") for r in got)
        assert sorted(r["text"] is None for r in got) == sorted(r["text"] is None for r in before)
    if name == "mixing":
        assert all((r["text"] or "").split() for r in got) and max(ids.values()) <= 4
