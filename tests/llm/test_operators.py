"""Small tests of the numbered operators: edge cases, and brute force where SQL cannot express one."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftkit.llm import html as pages_op
from siftkit.llm import licenses, mixing, neardup, packing, pii, quality, sharding, toxicity, vectors
from siftkit.llm.common import components, global_order, prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, idx long"


@pytest.fixture(scope="module")
def spark(spark):
    return prepare(spark)


def frame(spark, texts, sources=None):
    """Documents with extra columns whose names clash with those the operators add."""
    rows = [(i, t, "en", (sources or ["a"])[i % len(sources or ["a"])], len(t or ""), -1, -1)
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


ODD = ["One line of text here.", None, "", "   \n\t ", "One line of text here.", "x " * 30000 + "end.", "ü ß 漢字 text."]


def test_global_order_numbers_ties_and_skew(spark):
    df = spark.createDataFrame([(1, 2)] * 50 + [(k, 1) for k in range(40)], "k long, v long").repartition(5)
    rows = sorted(global_order(df, ["k"], ["v"], "t").collect(), key=lambda r: r["idx"])
    assert [r["idx"] for r in rows] == list(range(90))
    acc = 0
    for r in rows:
        assert r["before_v"] == acc
        acc += r["v"]
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)


def test_components_of_chains_stars_and_pairs(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}


def test_shards_are_contiguous_and_even(spark):
    texts = [("ab" * (i % 37)) if i % 11 else None for i in range(600)] + ["same"] * 300
    out = sharding.shard_by_bytes(frame(spark, texts)).collect()
    assert len(out) == 900
    for r in out:
        text = texts[r["doc_id"]] or ""
        assert r["size"] == len(text.encode()) + 1 and r["text_crc32"] == zlib.crc32(text.encode())
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r)
    total, most = sum(r["size"] for r in out), max(r["size"] for r in out)
    for s, rows in by.items():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert abs(sum(r["size"] for r in rows) - total / 8) <= most
        if s:
            assert min(r["doc_id"] for r in rows) > max(r["doc_id"] for r in by[s - 1])


def test_shards_of_no_rows_and_null_ids(spark):
    assert sharding.shard_by_bytes(frame(spark, ["a"]).limit(0)).count() == 0
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "doc_id long, text string")
    assert len(sharding.shard_by_bytes(df).collect()) == 3


def _sainte_lague(votes, seats):
    out = Counter()
    for _ in range(seats):
        k = min(votes, key=lambda s: (-votes[s] / (2 * out[s] + 1), s))
        out[k] += 1
    return out


def test_sainte_lague_against_brute_force(spark):
    votes = {"a": 530.0, "b": 240.0, "c": 240.0, "d": 11.0, "e": 3.0, "f": 0.0}
    parties = spark.createDataFrame([(k, v, 10 ** 6) for k, v in votes.items()], "source string, votes double, seats_max long")
    houses = [0, 1, 2, 5, 17, 100, 1001]
    got = {r["source"]: r["seats"] for r in mixing.sainte_lague(parties, houses).collect()}
    for h, seats in enumerate(houses):
        assert sum(s[h] for s in got.values()) == seats
        want = _sainte_lague(votes, seats)
        assert {k: got[k][h] for k in votes} == {k: want[k] for k in votes}


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(2 * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= over


def test_mix_reaches_targets(spark):
    texts = [" ".join(["w"] * (i * 7 % 90)) for i in range(900)] + ODD
    out = mixing.mix_sources(frame(spark, texts, ["b", "a", "a", "c", None, "d", "a"]), block=16).collect()
    assert len(out) == len(texts)
    sizes, taken, target = Counter(), Counter(), {}
    for r in out:
        assert r["size"] == len([w for w in (texts[r["doc_id"]] or "").split() if w])
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    want = _targets(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 4 * 16
    assert mixing.mix_sources(frame(spark, ["a"]).limit(0)).count() == 0
    assert all(r["taken"] == 0 for r in mixing.mix_sources(frame(spark, [None, ""])).collect())


def test_quality_rules_and_counts(spark):
    prose = " ".join(f"word{i}" for i in range(30)) + "."
    texts = [*ODD, prose, prose + "\nHome | About | News | Shop | Help | More | Us", "\n".join([prose] * 3),
             " ".join(f"w{i}###" for i in range(40)), " ".join(f"SHOUT{chr(65 + i % 26)}X!!" for i in range(40))]
    rows = {r["doc_id"]: r for r in quality.score_quality(frame(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        words = [w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        n = len(words)
        at = defaultdict(list)
        for p in range(n - 7):
            at[tuple(words[p:p + 8])].append(p)
        covered = {q for ps in at.values() if len(ps) > 1 for p in ps for q in range(p, p + 8)}
        assert (rows[i]["n_words"], rows[i]["word_chars"], rows[i]["n_repeat_words"]) == (
            n, sum(map(len, words)), len(covered)), i
        assert rows[i]["base_failed"] == (n < 20 or 100 * len(covered) > 30 * n)
    kept = sorted(i for i in rows if rows[i]["kept"])
    assert kept == [7, 8]
    cleaned = frame(spark, texts).select(quality.clean_lines(F.col("text")).alias("t")).where("t is not null").collect()
    assert prose in {r["t"] for r in cleaned} and not any("Home |" in r["t"] for r in cleaned)


def test_toxicity_learns_folds_and_spares(spark):
    clean = [f"The calm river {w} runs by the old mill number {i}." for i in range(120) for w in ("slow",)]
    toxic = [f"You are a nasty blockhead {'abcdefgh'[i % 8]}x{'qrstuvwz'[i // 8]} today." for i in range(60)]
    texts = clean + toxic
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i >= len(clean))) for i in range(len(texts))], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    assert any(toxicity.fold("blockhead ").strip().startswith(e.strip()) for e in lexicon.weights)
    probe = ["what a bl0ckhead", "what a вlockheаd", "the calm river", None, "", "calm " * 5000 + "blockhead"]
    got = sorted(toxicity.score_toxicity(frame(spark, probe), lexicon).collect(), key=lambda r: r["doc_id"])
    assert [r["predicted"] for r in got][:5] == [1, 1, 0, 0, 0]
    assert got[5]["n_matches"] == 1 and got[5]["score"] > got[2]["score"]   # far in a long text
    lexicon.exceptions = ["what " + toxicity.fold("a").strip()]
    spared = toxicity.Lexicon({toxicity.fold("blockhead").strip(): 5.0},
                              [f"{toxicity.fold('wooden blockhead').strip()}"], lexicon.model)
    assert not toxicity.matches(spared.automaton(), toxicity.fold("a wooden blockhead"))
    assert toxicity.matches(spared.automaton(), toxicity.fold("a rude blockhead"))
    none = toxicity.learn(docs, labels.limit(0))
    assert toxicity.score_toxicity(docs, none).filter("predicted = 1").count() == 0


def _licence_by_hand(text):
    """Every template at every start of a run of its pairs, without any bound."""
    p, found = licenses.pairs_of(text or ""), []
    for name, n, b in licenses.forms():
        b = set(b)
        for i, x in enumerate(p):
            if x in b and (i == 0 or p[i - 1] not in b):
                a = set(p[i:i + n])
                found.append((-(200 * len(a & b) // (len(a) + len(b))), name))
    found = [f for f in found if f[0] <= -licenses.MIN_DICE_PCT]
    return (min(found)[1], -min(found)[0], len(found)) if found else (None, None, 0)


def test_license_windows_against_brute_force(spark):
    import random
    import textwrap
    mit, apache, gpl = licenses.TEMPLATES["MIT"][2], licenses.TEMPLATES["Apache-2.0"][2], licenses.TEMPLATES["GPL-3.0"][1]
    rnd = random.Random(3)
    worn = " ".join("changed" if rnd.random() < 0.1 else w for w in mit.split())
    texts = [*ODD, "Intro.\nReleased under the MIT License.", "CC BY-NC 4.0", "licensed UNDER cc by nc 4.0!", "the license of it",
             "Released under\nthe MIT\nLicense. More text.",                                            # wrapped notice
             "The MIT License (MIT)\n\nCopyright (c) 2020 A. Person\n\n" + textwrap.fill(mit, 60),        # headed, wrapped
             "words before " * 300 + mit.upper() + " words after" * 300,                                  # one line, in the middle
             "\n".join("# " + x for x in textwrap.wrap(gpl, 50)) + "\ncode = 1", "// SPDX-License-Identifier: Apache-2.0",
             worn, mit[:len(mit) // 3], " ".join([mit] * 40), apache + "\n" + mit, "of the software " * 5000, gpl[80:]]
    got = {r["doc_id"]: (r["license"], r["dice"], r["n_windows"]) for r in licenses.scan_licenses(frame(spark, texts)).collect()}
    assert got == {i: _licence_by_hand(t) for i, t in enumerate(texts)}
    n = len(ODD)
    assert [got[i][0] for i in range(n + 4, n + 9)] == ["MIT", "MIT", "MIT", "GPL-3.0", "Apache-2.0"]
    assert got[n + 6][1] == 100 and got[n + 9][0] == "MIT" and got[n + 10][0] is None and got[n + 13][0] is None
    assert got[n + 12][0] == "Apache-2.0" and got[n + 14][0] == "GPL-3.0"
    assert licenses.scan_licenses(frame(spark, ["x"]).limit(0)).count() == 0
    own = licenses.scan_licenses(frame(spark, ["do what you like with it", "like it"]), {"Own": ("Do what you like with it.",)})
    assert {r["doc_id"]: r["license"] for r in own.collect()} == {0: "Own", 1: None}


def test_vectors_against_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    rows, base = [], rng.standard_normal((40, 16))
    for i in range(300):
        v = base[i % 40] + (0.0 if i % 5 == 0 else 0.12) * rng.standard_normal(16)
        rows.append((i, [float(x) for x in v], None if i % 50 == 49 else i % 3))
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [], 1),
             (304, [1.0, None] + [0.0] * 14, 1), (305, [1e200] * 16, 2), (306, [1e200] * 16, 2), (306, [1e200] * 16, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in vectors.near_vectors(df, block=32, window=64).collect())
    ok = [i for i, (k, v, lab) in enumerate(rows) if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1]) / max(map(abs, rows[i][1])) for i in ok}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    near = defaultdict(set)
    for a in ok:
        for b in ok:
            if a != b and rows[a][2] == rows[b][2] and unit[a] @ unit[b] >= 0.93:
                near[a].add(b)
    comp = {}
    for s in range(len(rows)):
        if s not in comp:
            todo, seen = [s], {s}
            while todo:
                for y in near[todo.pop()] - seen:
                    seen.add(y)
                    todo.append(y)
            for y in seen:
                comp[y] = min(rows[z][0] for z in seen)
    assert got == sorted((rows[i][0], len(near[i]), comp[i]) for i in range(len(rows)))
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_a_dense_group_lose_no_link(spark):
    import numpy as np
    rng = np.random.default_rng(6)
    # with a window of 8, one group of 600 near vectors, one of 200 very near ones whose keys are equal, and pairs
    groups = [(600, 0.03), (200, 1e-6), *[(2, 0.03)] * 40]
    x = np.concatenate([rng.standard_normal(32) + e * rng.standard_normal((n, 32)) for n, e in groups])
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>, label int").repartition(3)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((unit @ unit.T >= 0.93).sum(axis=1) - 1).tolist()
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(df, window=8, block=64).collect()}
    assert sorted(set(want)) == [1, 199, 599]
    assert [got[i] for i in range(len(x))] == want


def test_page_text(spark):
    page = ('<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li>Menu</li></ul></nav>'
            '<div class="ad">Buy</div><article><h1>Head &amp; more</h1><p>One\n two&nbsp;<b>three<br>four</p>'
            '<div class="comments"><p>first!</p></div><script>var t="</p>";</script><p>Last &#233;</p></article>'
            '<footer>&copy; host</footer>')
    rows = [(1, "http://h/a", page, 0), (2, "http://h/b", None, 0), (3, None, "", 0), (4, "x", "plain <text", 0), (1, "http://h/a", page, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in pages_op.extract_main_text(df).collect()]
    text = "Head & more\n\nOne two three four\n\nLast é"
    assert sorted(got) == sorted([(1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0), (4, "plain <text", 11)])


def test_repeated_host_text_goes_and_unique_runs_stay(spark):
    notice = "we use small files to make this site work better for you and all"
    rows = [(i, f"http://h/{i}", f"<div><p>{notice}</p><p>only{i} page says thing{i} here</p></div>") for i in range(12)]
    rows += [(50 + i, f"http://one{i}/", f"<article><p>{notice}</p></article>") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in pages_op.extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"only{i} page says thing{i} here" for i in range(12))
    assert all(got[50 + i] == notice for i in range(3))


def test_page_parts_that_stay():
    def text(html):
        return "|".join(pages_op.blocks_of(html)[0])
    assert text("<article><p>One</p><object data=x><p>Two</p><svg><p>Three</p></article>") == "One|Two|Three"
    assert text("<article><p>One</p><svg><text>no</text></svg><p>Two</p><script>rest") == "One|Two"
    assert text('<article><div class="post-header"><h1>Title</h1></div><figure><img><figcaption>Seen</figcaption></figure>') == "Title|Seen"
    assert text('<div class="site-header">Menu</div><p>Body</p>') == "Body"
    assert text("<p>x" + "<svg>" * 20000) == "x"


def slow_host_text(pages):
    """The rule on whole hosts: all substrings of DEPTH tokens, counted over different pages."""
    depth, out = pages_op.DEPTH, {}
    hosts = defaultdict(set)
    for _, host, blocks, article in pages:
        hosts[host].add((tuple(blocks), article))
    for i, host, blocks, article in pages:
        where = defaultdict(int)
        for other, _ in hosts[host]:
            ws = " ".join(other).split()
            for w in {tuple(ws[k:k + depth]) for k in range(len(ws) - depth + 1)}:
                where[w] += 1
        n = len(hosts[host])
        ws = " ".join(blocks).split()
        gone = set()
        for k in range(len(ws) - depth + 1):
            c = where[tuple(ws[k:k + depth])]
            if c >= pages_op.MIN_PAGES and c * 100 >= n * pages_op.SHARE_PCT:
                gone.update(range(k, k + depth))
        if article and (len(ws) - len(gone)) * 100 < len(ws) * pages_op.ARTICLE_REST_PCT:
            gone = set()
        kept, at = [], 0
        for b in blocks:
            m = len(b.split())
            left = " ".join(w for k, w in enumerate(b.split(), at) if k not in gone)
            at += m
            kept += [left] if left else []
        out[i] = "\n\n".join(kept)
    return out


@pytest.mark.parametrize("group", [256, 4])
def test_host_boilerplate_against_brute_force_whatever_the_groups(spark, monkeypatch, group):
    """Text goes from inside articles too; dealing a host into groups of four pages changes nothing."""
    import random
    monkeypatch.setattr(pages_op, "GROUP_PAGES", group)
    rng = random.Random(5)
    said = [" ".join(f"b{j}w{k}" for k in range(12)) for j in range(3)]
    pages = []
    for i in range(60):
        host = "big" if i < 45 else "small"
        own = [" ".join(f"p{i}x{rng.randrange(99)}" for _ in range(30)) for _ in range(2)]
        blocks = [own[0], *([said[0]] if i % 5 else []), *([said[1]] if i % 2 else []), *([said[2]] if i % 9 == 0 else []), own[1]]
        if i in (7, 8, 9):
            blocks = ["copied " * 30 + "text", said[0]]
        pages.append((i, host, blocks, i % 3 != 0))
    pages += [(100 + k, "few", [said[0] + f" at the end {k}"], False) for k in range(4)]
    pages += [(200 + k, "same", [said[0]], False) for k in range(9)]
    html = [(i, f"http://{h}/{i}", ("<article>" if a else "") + "".join(f"<p>{b}</p>" for b in bs)) for i, h, bs, a in pages]
    got = {r["page_id"]: r["text"] for r in pages_op.extract_main_text(
        spark.createDataFrame(html, "page_id long, url string, html string").repartition(5)).collect()}
    want = slow_host_text([(i, h, [" ".join(b.split()) for b in bs], a) for i, h, bs, a in pages])
    assert got == want
    inside = [i for i, h, bs, a in pages if a and h == "big" and want[i] != "\n\n".join(" ".join(b.split()) for b in bs)]
    assert len(inside) > 10


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string, text string, host string")
    assert pages_op.extract_main_text(none).collect() == []


def test_suffix_ranks_against_brute_force():
    import random
    rng = random.Random(3)
    streams = [[rng.randrange(4) for _ in range(rng.randrange(0, 60))] for _ in range(6)]
    depth = 4
    where = defaultdict(set)
    for p, s in enumerate(streams):
        for i in range(len(s) - depth + 1):
            where[tuple(s[i:i + depth])].add(p)
    got, _ = pages_op.repeated(streams, depth)
    for s, pages in zip(streams, got, strict=True):
        assert [int(x) for x in pages] == [len(where.get(tuple(s[i:i + depth]), ())) if i + depth <= len(s) else 0
                                           for i in range(len(s))]


def slow_base_spans(text):
    """The patterns of the contract as they stand."""
    import re
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, least, most in (("card", r"[0-9]([\x20-]?[0-9])+", 13, 19),
                                       ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == "phone" or pii.luhn(digits)):
                out.append((kind, *m.span()))
    return out


@given(st.text(alphabet="0123459.. -+()@a%", max_size=80))
@settings(max_examples=400, deadline=None)
def test_pii_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == slow_base_spans(text)


def test_pii_base_spans_in_linear_time():
    import time
    for text in ("7" * 400_000, "7" * 200_000 + "." + "8" * 200_000, "1." * 200_000, "a" * 400_000 + "@", "+1 " + "-" * 400_000,
                 "1 " * 200_000, "@" * 400_000):
        start = time.process_time()
        pii.base_spans(text)
        assert time.process_time() - start < 5


def test_pii_base_spans():
    import re
    text = ("a.b@x-y.co.uk@q.de 1.2.3.400 10.0.0.1 4111 1111 1111 1111 4111-1111-1111-1112 +1 (555) 010-9999 "
            "x@y @z.de +12 3.4.5.6.7.8 %@a.b..c")
    want = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    got = pii.base_spans(text)
    assert [s for s in got if s[0] == "email"] == want
    assert [text[s:e] for k, s, e in got if k == "ip"] == ["10.0.0.1", "3.4.5.6"]
    assert not [s for s in got if s[0] == "card"]                # the digits run on from the address before
    assert [(s, e) for k, s, e in pii.base_spans("no 4111 1111 1111 1111.") if k == "card"] == [(3, 22)]
    assert [text[s:e] for k, s, e in got if k == "phone"] == ["+1 (555) 010-9999"]
    assert pii.mask("see a@b.co now", [("email", 4, 10)]) == "see [EMAIL] now"


def _card(k):
    digits = f"4{k:014d}"
    return next(digits + str(d) for d in range(10) if pii.luhn(digits + str(d)))


def test_pii_patterns_of_several_kinds(spark):
    assert pii.shape("QX-77812-b é1") == "a-d5-a ad1"
    assert pii.contexts("x\nCard: 4111 then", 8, 12) == ["x card", "card <d4>", "<d4> then", "^card:"]
    assert pii.contexts("7" * 50 + "w" * 300 + " " * 300 + "to 12345", 653, 658) == ["to <d5>"]
    numbers = [_card(1000 + 37 * k) for k in range(12)]
    wrong = [n[:-1] + str((int(n[-1]) + 1) % 10) for n in numbers]
    texts = [f"w{k}x\nCard: {numbers[k]} q{k}z" for k in range(4)] + [f"w\nCard: {wrong[0]} end"]     # label at a line's start
    texts += [f"a{k}b paid {numbers[4 + k]} c{k}d" for k in range(4)] + [f"she paid {wrong[1]}", "she paid AB-1234"]   # word and shape
    texts += [f"e{k}f {numbers[8 + k]} expires" for k in range(4)] + [f"{wrong[2]} expires"]             # shape and the word behind
    texts += [f"nothing about {wrong[3]} here"]
    rows = {r["doc_id"]: r for r in pii.find_pii(frame(spark, texts)).collect()}
    got = {i: [texts[i][x["start"]:x["end"]] for x in r["found"]] for i, r in rows.items() if r["found"]}
    assert got == {4: [wrong[0]], 9: [wrong[1]], 15: [wrong[2]]}


def hash_of(value):
    return zlib.crc32(value.encode())


def test_pii_pattern_scores_against_brute_force(spark):
    import random
    rng = random.Random(11)
    edges = []
    for c in range(12):
        own = [f"v{c}-{k}" for k in range(9)] + [f"shared{rng.randrange(8)}" for _ in range(2)]
        edges += [(f"c{c}", v, (hash_of(v) % 12) < c) for v in own for _ in range(2)]
    conf = defaultdict(float)
    for c, v, seed in edges:
        conf[c, v] = max(conf[c, v], float(seed))
    first = dict(conf)

    def groups():
        out = defaultdict(list)
        for (c, _), x in conf.items():
            out[c].append(x)
        return out
    for _ in range(pii.ROUNDS):
        strong = {c: sum(x) / (len(x) + 1) for c, x in groups().items()
                  if sum(y >= pii.MIN_CONFIDENCE for y in x) >= pii.MIN_SUPPORT and sum(x) / (len(x) + 1) >= pii.MIN_CONFIDENCE / 2}
        via = defaultdict(float)
        for c, v in conf:
            via[v] = max(via[v], strong.get(c, 0.0))
        conf = {(c, v): max(x, via[v]) for (c, v), x in first.items()}
    want = {c for c, x in groups().items() if sum(y >= pii.MIN_CONFIDENCE for y in x) >= pii.MIN_SUPPORT
            and sum(x) / len(x) >= pii.MIN_CONFIDENCE}
    got = {r["context"] for r in pii.score_patterns(spark.createDataFrame(edges, "context string, value string, seed boolean")).collect()}
    assert got == want and 0 < len(want) < 12


def test_pii_bootstraps_unseen_identifiers(spark):
    texts = [f"Please reach me write to user{i}@mail.example.com today." for i in range(8)]
    texts += ["Please write to QX-77812-B at once.", "The number of 12345 things.", *ODD]
    rows = {r["doc_id"]: r for r in pii.find_pii(frame(spark, texts)).collect()}
    assert len(rows) == len(texts)
    found = rows[8]["found"]
    assert [texts[8][s["start"]:s["end"]] for s in found] == ["QX-77812-B"]
    assert not rows[9]["found"] and all(not rows[i]["base"] and not rows[i]["found"] for i in range(10, len(texts)))
    assert pii._with_found(spark.createDataFrame([], pii._FOUND_SCHEMA)).count() == 0
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def _near_classes(texts, n, percent):
    sets = [neardup.shingle_set(neardup.split_words(t), n) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(texts)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_against_brute_force(spark, n):
    import random
    rng = random.Random(11)
    texts = list(ODD) + ["word", "WORD", "two words"]
    for g in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(60 + g * 10)]
        for _ in range(rng.choice([1, 2, 12])):
            words = list(base)
            for _ in range(rng.randrange(0, 7)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(1000)}"
            texts.append(" ".join(words))
    texts += [texts[-1]] * 20
    want, sizes = _near_classes(texts, n, 80)
    out = neardup.near_duplicates(frame(spark, texts), shingle=n, crowd=8).collect()
    assert len(out) == len(texts)
    for r in out:
        assert (r["n_shingles"], r["component_id"]) == (sizes[r["doc_id"]], want[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert neardup.near_duplicates(frame(spark, ["a"]).limit(0)).count() == 0


def test_posterior_bounds_grow_with_the_evidence():
    steps = neardup.least_matches(180, 20, 80, 1e-6)
    assert [n for n, _ in steps] == list(range(20, 181, 20))
    shares = [m / n for n, m in steps]
    assert shares == sorted(shares) and shares[-1] < 0.8


def test_word_hashes_follow_the_words():
    texts = ["a b  c\td\x0b e\x85f g", "A b C", "", None, "x" * 5000 + " y", " lead and trail "]
    seen = {}
    for t in texts:
        words, hashes = neardup.split_words(t), neardup.word_hashes(t, piece=7)
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes.tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    texts = [" ".join(f"word{i * k}" for k in range(i % 60)) for i in range(200)] + ODD + ["<|endoftext|> é漢"] * 2
    out = packing.pack_documents(frame(spark, texts), limit=256, chunk=64).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    total = 0
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in pieces] == packing.cut_points(len(ids), 256)
        for r in pieces:
            part = b"".join(x.to_bytes(4, "little") for x in ids[r["start"]:r["start"] + r["length"]])
            assert r["ids_crc32"] == zlib.crc32(part)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256
    assert len(by_seq) <= -(-total // 256) * 1.05 + 2
    assert packing.pack_documents(frame(spark, ["a"]).limit(0)).count() == 0


def test_ids_of_special_strings_and_endless_runs():
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a <|endoftext|> b", "<|endoftext|>", "<|endoftext|", " " * 1_000_000 + "x", "7" * 300_000, "a" * 300_000,
                 "\n" * 300_000, "-=" * 150_000, "漢" * 100_000):
        assert packing.encode(text).tolist() == tok.encode(text, add_special_tokens=False).ids


def test_local_search_tries_every_pair_of_a_bin():
    # only the two shortest of the victim's twenty documents fill the place of the other bin's document of 5
    lengths = [3 + 2 * k for k in range(20)] + [8, 431, 440 - 8]
    bins = packing.local_search(lengths, [list(range(20)), [20, 21], [22]], 440)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert len(bins) == -(-sum(lengths) // 440)


def test_local_search_empties_bins_and_keeps_documents():
    import random
    lengths = [7, 3, 6, 4]
    assert sorted(map(sorted, packing.local_search(lengths, [[0], [1, 2], [3]], 10))) == [[0, 1], [2, 3]]
    rng = random.Random(2)
    lengths = [rng.randrange(1, 90) for _ in range(200)]
    start = [[i] for i in range(200)]
    bins = packing.local_search(lengths, start, 100)
    assert sorted(i for b in bins for i in b) == list(range(200))
    fills = [sum(lengths[i] for i in b) for b in bins]
    assert max(fills) <= 100 and sum(f * f for f in fills) >= sum(x * x for x in lengths)
    assert len(packing.local_search(lengths, packing.best_fit(lengths, 100), 100)) <= -(-sum(lengths) // 100) + 4
    assert packing.best_fit([], 10) == [] and packing.local_search([], [], 10) == []
