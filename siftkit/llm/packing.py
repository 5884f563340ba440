"""Operator 10: packing token sequences by best fit and swap-based local search."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, store, table

VOCABULARY = "byte_bpe_50k"
LIMIT = 2048            # tokens in a sequence
END = 0                 # id after every document
CHUNK = 4096            # pieces searched together in one task

_ENCODERS: dict[str, object] = {}


def _encoder(name: str):
    """The public vocabulary as byte-level BPE ranks, at a sixth of the cost of its ``tokenizers`` file."""
    if name not in _ENCODERS:
        import base64

        import public_tokenizers
        import tiktoken
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[name] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                            special_tokens={})
    return _ENCODERS[name]


def _tokenizer(name: str):
    """The ``tokenizers`` file itself, and the strings of its special tokens."""
    key = f"{name}.json"
    if key not in _ENCODERS:
        import public_tokenizers
        from tokenizers import Tokenizer
        full = Tokenizer.from_file(public_tokenizers.path(key))
        _ENCODERS[key] = full, [t.content for t in full.get_added_tokens_decoder().values()]
    return _ENCODERS[key]


def encode(text: str, vocabulary: str = VOCABULARY):
    """Ids of a whole text, those that ``tokenizers`` gives without added special tokens.

    A text that holds the string of a special token goes through ``tokenizers``, and
    so does one with a run of characters too long for the faster matcher.
    """
    import numpy as np
    full, specials = _tokenizer(vocabulary)
    if not any(mark in text for mark in specials):
        try:
            return _encoder(vocabulary).encode_to_numpy(text, disallowed_special=())
        except ValueError:
            pass
    return np.asarray(full.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def cut_points(length: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of one document: whole sequences at the end, the rest first."""
    first = length if length <= limit else (length % limit or limit)
    return [(0, first), *((s, limit) for s in range(first, length, limit))]


def _pieces(batches: Iterator[pd.DataFrame], vocabulary: str, limit: int) -> Iterator[pd.DataFrame]:
    import zlib

    import numpy as np
    for pdf in batches:
        ids, pieces, starts, lengths, crcs = [], [], [], [], []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            tokens = np.append(encode(text or "", vocabulary), END).astype("<u4")
            for k, (start, n) in enumerate(cut_points(len(tokens), limit)):
                ids.append(doc_id)
                pieces.append(k)
                starts.append(start)
                lengths.append(n)
                crcs.append(zlib.crc32(tokens[start:start + n].tobytes()))
        yield pd.DataFrame({"doc_id": pd.Series(ids, dtype="Int64"), "piece": pd.Series(pieces, dtype="int32"),
                            "start": pd.Series(starts, dtype="int64"), "length": pd.Series(lengths, dtype="int64"),
                            "ids_crc32": pd.Series(crcs, dtype="int64")})


def best_fit(lengths: list[int], limit: int) -> list[list[int]]:
    """Best fit decreasing: bins as lists of places in ``lengths``."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    open_rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        fitting = open_rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = limit, len(bins)
            bins.append([i])
        left = room - n
        if left:
            by_room[left].append(b)
            open_rooms |= 1 << left
    return bins


def local_search(lengths: list[int], bins: list[list[int]], limit: int) -> list[list[int]]:
    """Empty bins by moves and swaps between underfull bins, each raising the sum of squared fills.

    The least filled bin is the victim: its documents move to the fullest
    bin with room; a document is exchanged for a shorter one, or two of its
    documents for one shorter than both together, of a bin at least as full
    that then gets fuller. A victim that no step improves is closed. Stops
    at the lower bound on the number of bins.
    """
    import numpy as np
    need = -(-sum(lengths) // limit)
    size = np.asarray(lengths, dtype=np.int64)
    bins = [list(b) for b in bins]
    fill = np.array([int(size[b].sum()) for b in bins], dtype=np.int64)
    home = np.empty(len(lengths), dtype=np.int64)
    for b, docs in enumerate(bins):
        home[docs] = b
    alive, closed = len(bins), set()
    open_bins = {b for b in range(len(bins)) if fill[b] < limit}

    def put(i: int, b: int) -> None:
        a = int(home[i])
        bins[a].remove(i)
        bins[b].append(i)
        home[i] = b
        fill[a] -= size[i]
        fill[b] += size[i]

    def step(v: int, others: np.ndarray, docs: np.ndarray) -> bool:
        room = limit - fill
        mine = sorted(bins[v], key=lambda i: (-lengths[i], i))
        for i in mine:                                           # move
            fits = others[(room[others] >= size[i]) & (fill[others] + size[i] > fill[v])]
            if len(fits):
                put(i, int(fits[np.argmin(room[fits])]))
                return True
        at = home[docs]
        ok = (fill[at] >= fill[v]) & (at != v)
        # one for one and two for one, one pair for every pair of lengths; for each document of
        # another bin the largest such total that still fits in its place
        by_total: dict[int, tuple[int, ...]] = {}
        alike = Counter()
        tried = []
        for i in mine:
            alike[lengths[i]] += 1
            if alike[lengths[i]] > 2:                            # more of a length give no new total
                continue
            for j in tried:
                by_total.setdefault(lengths[i] + lengths[j], (j, i))
            tried.append(i)
        by_total.update({lengths[i]: (i,) for i in reversed(mine)})
        totals = np.array(sorted(by_total), dtype=np.int64)
        most = size[docs] + room[at]
        pick = np.searchsorted(totals, most, side="right") - 1
        total = totals[np.maximum(pick, 0)]
        good = ok & (pick >= 0) & (total > size[docs])
        if not good.any():
            return False
        k = int(np.argmin(np.where(good, most - total, limit + 1)))
        best = by_total[int(total[k])], int(docs[k])
        b = int(home[best[1]])
        put(best[1], v)
        for i in best[0]:
            put(i, b)
        return True

    while alive > need:
        victims = [b for b in open_bins if b not in closed and bins[b]]
        if not victims:
            break
        v = min(victims, key=lambda b: (fill[b], b))
        while bins[v] and alive > need:
            others = np.array(sorted(b for b in open_bins if b != v and bins[b] and fill[b] < limit), dtype=np.int64)
            if not len(others):
                break
            docs = np.array([i for b in others for i in bins[b]], dtype=np.int64)
            if not step(v, others, docs):
                break
        if bins[v]:
            closed.add(v)
        else:
            alive -= 1
            open_bins.discard(v)
    return [b for b in bins if b]


def _pack(pdf: pd.DataFrame, limit: int) -> pd.DataFrame:
    pdf = pdf.sort_values("uid", kind="stable").reset_index(drop=True)
    lengths = [int(x) for x in pdf["length"]]
    bins = local_search(lengths, best_fit(lengths, limit), limit)
    where = [0] * len(lengths)
    offset = [0] * len(lengths)
    fill = [0] * len(lengths)
    for b, docs in enumerate(bins):
        at = 0
        for i in sorted(docs):
            where[i], offset[i] = b, at
            at += lengths[i]
        for i in docs:
            fill[i] = at
    return pdf.assign(bin=pd.Series(where, dtype="int64"), offset=pd.Series(offset, dtype="int64"),
                      fill=pd.Series(fill, dtype="int64"))


def tokenize(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        lambda batches: _pieces(batches, vocabulary, limit), schema)


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, chunk: int = CHUNK,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``limit`` tokens.

    A document is its ids and then id 0; longer ones are cut into whole
    sequences, what is over going first. Whole-sequence pieces stand alone.
    The others are dealt at random (by hash of their row number) into chunks
    of about ``chunk`` pieces; each chunk is packed by best fit decreasing
    and then by :func:`local_search`. Bins that stay underfull are opened
    again and their pieces packed a second time in chunks of their own, so
    that a chunk's last bins do not stay half empty. Chunks have a fixed
    size at any scale; only piece lengths are shuffled, never texts.

    Null and empty texts: one piece, the id 0. Repeated rows are packed each
    for itself. Null ids are kept. No rows: no rows. Extra columns are ignored.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    pieces = store(tokenize(docs, vocabulary, limit, id_col, text_col)
                   .withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    full = pieces.filter(F.col("length") == limit)
    rest = pieces.filter(F.col("length") < limit)

    def search(rows: DataFrame, turn: int) -> DataFrame:
        chunks = max(1, -(-rows.count() // chunk))
        dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(chunks)))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
        return store(dealt.groupBy("chunk").applyInPandas(
            lambda pdf: _pack(pdf, limit), f"{schema}, bin long, offset long, fill long"), f"pack-turn{turn}")

    one = search(rest, 1)
    slack = max(1, limit // 64)
    open_again = F.col("fill") < limit - slack
    two = search(one.filter(open_again).drop("chunk", "bin", "offset", "fill"), 2)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def numbered(rows: DataFrame, turn: int) -> DataFrame:  # turn, chunk and bin tell sequences apart
        return rows.select(*columns, ((F.col("chunk") * 65536 + F.col("bin")) * 4 + turn).alias("sequence_id"), "offset")

    return (full.select(*columns, (F.col("uid") * 4).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
            .unionByName(numbered(one.filter(~open_again), 1)).unionByName(numbered(two, 2)))


def op10_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack_documents(table(spark, sf_dir, "documents"))
