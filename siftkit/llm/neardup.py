"""Operator 9: MinHash near-duplicates with sequential Bayesian verification."""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, discard, prepare, store, table, text_hash

BANDS, ROWS = 36, 5       # a pair at 0.8 shares no band with probability 6e-7, one band only with 1e-5
BATCH = 20                # signature entries compared at a time
MISS = 1e-6               # chance at which a pair at the threshold may be pruned
CROWD = 512               # families beyond this size are compared block by block
TURNS = 3                 # rounds in which documents are compared with a random member of their buckets
SEED = 20240229


def split_words(text: str | None) -> list[bytes]:
    """ASCII lower case, cut at ASCII white space (bytes methods touch no other characters)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], n: int) -> set:
    if not words:
        return set()
    if len(words) < n:
        return {tuple(words)}
    return set(zip(*[words[i:] for i in range(n)], strict=False))


@functools.lru_cache(maxsize=1)
def _byte_tables():
    import numpy as np
    rng = np.random.default_rng(SEED)
    space = np.zeros(256, dtype=bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    lower = np.arange(256)
    lower[65:91] += 32
    letters = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return space, letters[lower], rng.integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(text: str | None, piece: int = 1 << 20):
    """64-bit hashes of the words of :func:`split_words`, in order, a megabyte at a time."""
    import numpy as np
    space, letters, places = _byte_tables()
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out, at = [], 0
    while at < len(data):
        end = min(at + piece, len(data))
        while end < len(data) and not space[data[end]]:     # never cut a word
            end += 1
        x = data[at:end]
        at = end
        word = ~space[x]
        start = word.copy()
        start[1:] &= ~word[:-1]
        starts = np.flatnonzero(start)
        if not len(starts):
            continue
        idx = np.arange(len(x))
        place = idx - np.maximum.accumulate(np.where(start, idx, 0))
        value = letters[x] * places[place & 4095]
        value[~word] = 0
        h = np.add.reduceat(value, starts)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        out.append(h)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _shingle_hashes(h, n: int):
    """64-bit hashes of the shingles of words given by hash, repeats included."""
    import numpy as np
    k = min(n, len(h))
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        out = (out ^ h[i:len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


@functools.lru_cache(maxsize=4)
def _coefficients(k: int):
    import numpy as np
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, 1 << 31, k, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, k, dtype=np.uint32)[:, None])


def signature(hashes, bands: int, rows: int):
    """MinHash signature of a set of shingle hashes: bands * rows minima of 32-bit linear permutations."""
    import numpy as np
    a, b = _coefficients(bands * rows)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(a), np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(x), 512):                # stays in cache, and bounded for very long texts
        v = a * x[None, at:at + 512]
        v += b
        np.minimum(best, v.min(axis=1), out=best)
    return best


def band_keys(sig, bands: int, rows: int):
    import numpy as np
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    part = sig.reshape(bands, rows).astype(np.uint64)
    for r in range(rows):
        key = (key ^ part[:, r]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key.astype(np.int64)


_SIGNED = "uid long, doc_id long, n_shingles long, copy_key string, bands array<long>, sig binary"


def _sign(batches: Iterator[pd.DataFrame], n: int, bands: int, rows: int) -> Iterator[pd.DataFrame]:
    import numpy as np
    for pdf in batches:
        sizes, keys, band_list, sigs = [], [], [], []
        for text in pdf["text"]:
            words = word_hashes(text)
            if not len(words):
                sizes.append(0)
                keys.append(None)
                band_list.append(None)
                sigs.append(None)
                continue
            keys.append(hashlib.blake2b(words.tobytes(), digest_size=16).hexdigest())
            shingles = np.unique(_shingle_hashes(words, n))
            sizes.append(len(shingles))
            sig = signature(shingles, bands, rows)
            band_list.append(band_keys(sig, bands, rows))
            sigs.append((sig >> np.uint32(11)).astype(np.uint8).tobytes())
        yield pd.DataFrame({"uid": pdf["uid"], "doc_id": pdf["doc_id"].astype("Int64"), "n_shingles": sizes,
                            "copy_key": keys, "bands": band_list, "sig": sigs})


def least_matches(k: int, batch: int, percent: int, miss: float) -> list[tuple[int, int]]:
    """(entries compared, fewest matches) after each batch; fewer matches prune a pair.

    With a flat prior the share of matching entries, given m of n, follows a
    Beta(m + 1, n - m + 1) posterior. A pair is pruned when the posterior
    chance that its similarity reaches the threshold is below ``miss``.
    Entries are kept as 8 bits, so unlike ones match by chance 1 in 256.
    """
    t = percent / 100 + (1 - percent / 100) / 256

    def above(m: int, n: int) -> float:  # P(Beta(m + 1, n - m + 1) > t) = P(Binomial(n + 1, t) <= m)
        return sum(math.comb(n + 1, i) * t ** i * (1 - t) ** (n + 1 - i) for i in range(m + 1))

    out = []
    for n in range(batch, k + 1, batch):
        out.append((n, next(m for m in range(n + 1) if above(m, n) >= miss)))
    return out


def _bayes(steps: list[tuple[int, int]]):
    @F.pandas_udf("boolean")
    def survives(a: pd.Series, b: pd.Series) -> pd.Series:
        import numpy as np
        if not len(a):
            return pd.Series([], dtype=bool)
        x = np.frombuffer(b"".join(a), dtype=np.uint8).reshape(len(a), -1)
        y = np.frombuffer(b"".join(b), dtype=np.uint8).reshape(len(b), -1)
        alive, got, at = np.arange(len(a)), np.zeros(len(a), dtype=np.int64), 0
        for n, least in steps:                       # only the pairs still alive are compared further
            got[alive] += (x[alive, at:n] == y[alive, at:n]).sum(axis=1)
            alive, at = alive[got[alive] >= least], n
        keep = np.zeros(len(a), dtype=bool)
        keep[alive] = True
        return pd.Series(keep)
    return survives


def _exact(n: int, percent: int):
    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out, last, last_set = [], None, set()
        for x, y in zip(a, b, strict=True):
            if y != last:
                last, last_set = y, shingle_set(split_words(y), n)
            mine = shingle_set(split_words(x), n)
            both = len(mine & last_set)
            out.append(100 * both >= percent * (len(mine) + len(last_set) - both))
        return pd.Series(out, dtype=bool)
    return linked


class _Links:
    """Checks candidate pairs of representatives: sizes, Bayesian comparison of signatures, then full sets."""

    def __init__(self, docs: DataFrame, reps: DataFrame, n: int, percent: int, bands: int, rows: int, batch: int,
                 miss: float, id_col: str, text_col: str):
        self.n, self.percent = n, percent
        self.survives = _bayes(least_matches(bands * rows, batch, percent, miss))
        self.reps = reps.select("uid", "doc_id", "n_shingles", "sig", "text_hash")
        self.texts = docs.select(F.col(id_col).cast("long").alias("t_id"), text_hash(F.col(text_col)).alias("t_hash"),
                                 F.col(text_col).alias("text"))

    def texts_of(self, uids: DataFrame) -> DataFrame:
        """The texts (uid, text) of some representatives."""
        needed = store(self.reps.join(uids, "uid").select("uid", F.col("doc_id").alias("n_id"),
                                                          F.col("text_hash").alias("n_hash")), "neardup-needed")
        # a fixed set of hash slots (2^20 at most, whatever the input) drops most other texts before the shuffle
        slot = F.pmod(F.xxhash64("n_hash"), F.lit(1 << 20))
        slots = needed.select(slot.alias("slot")).distinct()
        texts = self.texts.join(F.broadcast(slots), F.pmod(F.xxhash64("t_hash"), F.lit(1 << 20)) == F.col("slot"),
                                "left_semi")
        # one row for each needed text, however often documents repeat it
        texts = (needed.join(texts, F.col("n_id").eqNullSafe(F.col("t_id")) & (F.col("n_hash") == F.col("t_hash")))
                 .select("uid", "text").dropDuplicates(["uid"]))
        out = store(texts, "neardup-texts")
        discard(needed)
        return out

    def check(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b) those whose full sets reach the threshold."""
        side = [self.reps.select(*[F.col(c).alias(f"{x}_{c}") for c in ("uid", "n_shingles", "sig")]) for x in "ab"]
        low, high = F.least("a_n_shingles", "b_n_shingles"), F.greatest("a_n_shingles", "b_n_shingles")
        alive = (pairs.join(side[0], F.col("a") == F.col("a_uid")).join(side[1], F.col("b") == F.col("b_uid"))
                 .filter(low * 100 >= high * self.percent)
                 .filter(self.survives("a_sig", "b_sig")).select("a", "b"))
        alive = store(alive, "neardup-alive")
        texts = self.texts_of(alive.select(F.explode(F.array("a", "b")).alias("uid")).distinct())
        left = texts.select(F.col("uid").alias("a"), F.col("text").alias("a_text"))
        right = texts.select(F.col("uid").alias("b"), F.col("text").alias("b_text"))
        linked = _exact(self.n, self.percent)
        both = alive.join(left, "a").join(right, "b")
        out = store(both.filter(linked("a_text", "b_text")).select("a", "b"), "neardup-links")
        discard(alive, texts)
        return out


def _mixed(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, uid, comp) of the buckets that still hold several components."""
    placed = (shared.select("key", "uid").join(roots.select(F.col("node").alias("uid"), "root"), "uid", "left")
              .select("key", "uid", F.coalesce("root", "uid").alias("comp")))
    several = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi")
    return store(placed.join(several.select("key"), "key"), "neardup-mixed")


def _families(mixed: DataFrame, reps: DataFrame) -> DataFrame:
    """(uid, comp, fam): documents of mixed buckets, joined into families.

    Members of a bucket that share two bands with one of its heads (the
    first and a random one) are of one family, so two documents that share several
    buckets are in one family but for a negligible chance, while chance
    collisions of one band join nothing. Pairs stay in proportion to rows.
    """
    heads = mixed.groupBy("key").agg(F.min("uid").alias("h0"), F.min_by("uid", F.xxhash64("uid", F.lit(-1))).alias("h1"))
    edges = (mixed.join(heads, "key").select("uid", F.explode(F.array("h0", "h1")).alias("head"))
             .filter("uid != head").distinct())
    bands = reps.select(F.col("uid").alias("b_uid"), "bands")
    near = (edges.join(bands.withColumnRenamed("bands", "x"), F.col("uid") == F.col("b_uid")).drop("b_uid")
            .join(bands.withColumnRenamed("bands", "y"), F.col("head") == F.col("b_uid"))
            .filter(F.size(F.array_intersect("x", "y")) >= 2))
    roots = components(near.select(F.col("uid").alias("a"), F.col("head").alias("b")), "neardup-families")
    placed = mixed.select("uid", "comp").distinct().join(
        roots.select(F.col("node").alias("uid"), F.col("root").alias("fam")), "uid")
    several = placed.groupBy("fam").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                        F.count("*").alias("n")).filter("lo != hi").select("fam", "n")
    return placed.join(several, "fam")


def _compare_blocks(n: int, percent: int, bands: int, rows: int, batch: int, miss: float):
    """Links between the documents of two blocks of a family (or within one), as a forest."""
    steps = least_matches(bands * rows, batch, percent, miss)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        pdf = pdf.drop_duplicates("uid").sort_values("uid", kind="stable").reset_index(drop=True)
        block, comp, uid = (pdf[c].to_numpy() for c in ("block", "comp", "uid"))
        hashes = [np.unique(_shingle_hashes(word_hashes(t), n)) for t in pdf["text"]]
        size = np.array([len(h) for h in hashes], dtype=np.int64)
        sig = np.stack([signature(h, bands, rows) for h in hashes])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        alive = np.zeros((len(left), len(right)), dtype=bool)
        for k, a in enumerate(left):                 # sizes, then batches of the signature under the bounds
            ok = np.flatnonzero((comp[right] != comp[a]) & ((uid[right] > uid[a]) | (i != j))
                                & (np.minimum(size[a], size[right]) * 100 >= np.maximum(size[a], size[right]) * percent))
            got, at = np.zeros(len(right), dtype=np.int64), 0
            for m, least in steps:
                got[ok] += (sig[right[ok], at:m] == sig[a, at:m]).sum(axis=1)
                ok, at = ok[got[ok] >= least], m
            alive[k, ok] = True
        ls, rs = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        out = []
        if len(ls):
            # shared shingles of the survivors, counted on the full sets a few thousand shingles at a time
            docs = np.concatenate([left[ls], right[rs]])
            owner = np.repeat(np.arange(len(docs)), size[docs])
            value, code = np.unique(np.concatenate([hashes[d] for d in docs]), return_inverse=True)
            order = np.argsort(code, kind="stable")
            owner, code = owner[order], code[order]
            both = np.zeros((len(ls), len(rs)))
            for lo in range(0, len(value), 4096):
                s, e = np.searchsorted(code, [lo, lo + 4096])
                m = np.zeros((len(docs), 4096), dtype=np.float32)
                m[owner[s:e], code[s:e] - lo] = 1
                both += m[:len(ls)] @ m[len(ls):].T
            both = np.rint(both).astype(np.int64)
            union = size[left[ls]][:, None] + size[right[rs]][None, :] - both
            x, y = np.nonzero(alive[np.ix_(ls, rs)] & (100 * both >= percent * union))
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while parent.get(c, c) != c:
                    c = parent[c]
                return c

            for a, b in zip(left[ls[x]], right[rs[y]], strict=True):   # links that join two components
                ra, rb = root(int(comp[a])), root(int(comp[b]))
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                    out.append((int(uid[a]), int(uid[b])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def _family_links(family: DataFrame, texts: DataFrame, crowd: int, compare) -> DataFrame:
    """All links between different components of a family, block against block; ``texts`` has (uid, text)."""
    cut = family.withColumn("blocks", F.ceil(F.col("n") / crowd).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = (cut.select("fam", "uid", "comp", "block", other)
             .select("fam", "uid", "comp", "block", F.least("block", "other").alias("i"),
                     F.greatest("block", "other").alias("j")))
    return units.join(texts, "uid").groupBy("fam", "i", "j").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    batch: int = BATCH, miss: float = MISS, turns: int = TURNS, crowd: int = CROWD, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Classes of documents linked by a Jaccard similarity of at least ``percent`` / 100 of their word shingles.

    1. One pass over the texts gives each document's set size, a key of its
       word sequence, band keys and an 8-bit MinHash signature. Exact copies
       collapse to one representative (minimum by key, pre-aggregated).
    2. Each representative is paired with the first one of its buckets
       (one candidate a document, so a bucket of any size gives no more
       pairs than rows); pairs are pruned by size, then by posterior bounds
       over batches of signature entries, and survivors are confirmed on
       their full sets. Links give components.
    3. In a few turns, documents are paired with a random member, of another component, of
       their buckets; that merges the components of large groups with a
       number of pairs in proportion to the documents.
    4. What still shares buckets with other components forms families of
       documents that share two bands. A family is cut into blocks, and
       pairs of blocks are compared in tasks of bounded size: signatures under the
       posterior bounds, then full sets. Only links that join components
       leave a task, never pairs. Pairs inside one component need no check.

    A pair at the threshold is missed with a probability of about 1e-5
    (fewer than two shared bands, or pruned).

    Texts without words (null, empty, white space) have no set and link with
    nothing. A text with fewer words than a shingle is one shingle. Long
    texts count whole. Rows equal in id are told apart by row number;
    ``component_id`` is the smallest id of the class (null ids are passed
    over), ``kept`` whether the row's id is that id. Extra columns are ignored.
    No rows: no rows.

    Returns uid (row number), doc_id, n_shingles, component_id, kept, rep
    (row number of the representative of equal texts), first (whether the
    row is the one to keep of its class), text_hash (of the raw text).
    """
    numbered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                           F.monotonically_increasing_id().alias("uid"))
    hashed = numbered.withColumn("text_hash", text_hash(F.col("text")))
    signed = store(hashed.mapInPandas(lambda it: _sign_with(it, shingle, bands, rows), _SIGNED + ", text_hash long"),
                   "neardup-signed")
    copies = signed.filter(F.col("copy_key").isNotNull()).groupBy("copy_key").agg(F.min("uid").alias("rep"))
    members = store(signed.select("uid", "doc_id", "n_shingles", "copy_key", "text_hash").join(copies, "copy_key", "left")
                    .select("uid", "doc_id", "n_shingles", "text_hash", F.coalesce("rep", "uid").alias("rep"),
                            F.col("copy_key").isNotNull().alias("has_words")), "neardup-members")
    chosen = members.filter(F.col("has_words") & (F.col("uid") == F.col("rep"))).select("uid")
    reps = store(signed.join(chosen, "uid", "left_semi").drop("copy_key"), "neardup-reps")
    discard(signed)
    keyed = reps.select("uid", F.explode("bands").alias("key"))
    shared = store(keyed.join(keyed.groupBy("key").agg(F.min("uid").alias("head"), F.count("*").alias("n"))
                              .filter("n > 1").select("key", "head"), "key"), "neardup-buckets")
    links = _Links(docs, reps, shingle, percent, bands, rows, batch, miss, id_col, text_col)

    heads = shared.filter(F.col("uid") != F.col("head")).groupBy("uid").agg(F.min("head").alias("b"))
    found = links.check(heads.select(F.col("uid").alias("a"), "b"))
    roots = components(found, "neardup-merge")
    for turn in range(turns):
        mixed = _mixed(shared, roots)
        head = mixed.groupBy("key").agg(F.min_by(F.struct("uid", "comp"), F.xxhash64("uid", F.lit(turn))).alias("h"))
        pairs = (mixed.join(head, "key").filter(F.col("comp") != F.col("h.comp"))
                 .groupBy("uid", F.col("h.comp").alias("other")).agg(F.min("h.uid").alias("b")))
        new = links.check(pairs.select(F.greatest("uid", "b").alias("a"), F.least("uid", "b").alias("b")).distinct())
        merged = store(found.unionByName(new), "neardup-found")
        discard(mixed, new, found, roots)
        found = merged
        roots = components(found, "neardup-merge")
    mixed = _mixed(shared, roots)
    family = store(_families(mixed, reps), "neardup-family")
    texts = links.texts_of(family.select("uid"))
    last = store(_family_links(family, texts, crowd, _compare_blocks(shingle, percent, bands, rows, batch, miss)),
                 "neardup-last")
    discard(mixed, shared, reps, family, texts, roots)
    roots = components(found.unionByName(last), "neardup-last")
    discard(found, last)

    nodes = store(members.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
                  .withColumn("root", F.coalesce("root", "rep")), "neardup-nodes")
    lowest = nodes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = nodes.join(lowest, "root")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    discard(members, roots)
    firsts = store(out.select("uid", "doc_id", "n_shingles", "text_hash", "component_id", kept.alias("kept"), "rep", "root"),
                   "neardup-out")
    discard(nodes)
    keepers = firsts.filter("kept").groupBy("root").agg(F.min("uid").alias("keeper"))
    return (firsts.join(keepers, "root", "left")
            .select("uid", "doc_id", "n_shingles", "component_id", "kept", "rep", "text_hash",
                    (F.col("uid") == F.coalesce("keeper", "rep")).alias("first")))


def _sign_with(batches, n, bands, rows):
    """The signatures, with the hash of the raw text beside them."""
    for pdf in batches:
        for out in _sign(iter([pdf]), n, bands, rows):
            yield out.assign(text_hash=pdf["text_hash"].to_numpy())


def op9_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
