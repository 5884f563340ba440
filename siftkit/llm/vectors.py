"""Operator 6: near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, global_order, prepare, store, table

PASSES = 16
BITS = 30                # hashes concatenated to the sort key of a pass
WINDOW = 256             # neighbours after a vector that it is compared with
BLOCK = 1024             # rows a task compares at once, plus the window
MIN_COSINE = 0.93
SEED = 20240301


def _planes(dim: int, passes: int, bits: int):
    import numpy as np
    return np.random.default_rng(SEED).standard_normal((dim, passes * bits))


def _keys(passes: int, bits: int):
    def run(batches):
        import numpy as np
        for pdf in batches:
            out: list = [None] * len(pdf)
            dims = pdf["vector"].map(len)
            for dim, rows in pdf.groupby(dims.to_numpy()).groups.items():
                at = pdf.index.get_indexer(rows)
                x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["vector"].iloc[at]])
                signs = (x @ _planes(int(dim), passes, bits) > 0).reshape(len(at), passes, bits)
                keys = signs @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))
                for i, k in zip(at, keys, strict=True):
                    out[i] = k
            yield pdf.assign(keys=out)
    return run


def _units(pdf: pd.DataFrame):
    """The vectors of a frame at length 1, padded with zeros to the longest."""
    import numpy as np
    dims = pdf["vector"].map(len).to_numpy()
    x = np.zeros((len(pdf), int(dims.max())))
    for i, v in enumerate(pdf["vector"]):
        x[i, :dims[i]] = v
    x /= np.abs(x).max(axis=1, keepdims=True)          # keeps squares of extreme values finite
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x, dims


def _compare(window: int, min_cosine: float):
    """A forest of the links of one block of one pass."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        pdf = pdf.sort_values("idx", kind="stable").reset_index(drop=True)
        own = (pdf["own"]).to_numpy(bool)
        label, node = (pdf[c].to_numpy() for c in ("label", "node"))
        x, dims = _units(pdf)
        parent = np.arange(len(pdf))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = int(parent[i])
            return i

        for a in range(0, int(own.sum()), 256):
            b = min(a + 256, int(own.sum()))
            hi = min(b + window, len(pdf))
            close = x[a:b] @ x[a:hi].T >= min_cosine
            close &= (label[a:b, None] == label[None, a:hi]) & (dims[a:b, None] == dims[None, a:hi])
            i, j = np.nonzero(close)
            i, j = i + a, j + a
            ok = (j > i) & (j - i <= window)
            for u, v in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
                ru, rv = root(u), root(v)
                if ru != rv:
                    parent[max(ru, rv)] = min(ru, rv)
        roots = np.array([root(i) for i in range(len(pdf))])
        keep = roots != np.arange(len(pdf))
        return pd.DataFrame({"node": node[keep], "other": node[roots[keep]]})
    return run


def _count(min_cosine: float):
    """Links of one pair of blocks: each row's, with the other block or within the one block, inside its component."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        one = int(pdf["low"].iloc[0]) == int(pdf["high"].iloc[0])
        # one order of the rows whatever the task got first, so that a pair's product is the same both ways
        pdf = pdf.sort_values(["home", "idx"], kind="stable").reset_index(drop=True)
        node, size, part = (pdf[c].to_numpy() for c in ("node", "size", "root"))
        x, _ = _units(pdf)
        left = np.arange(len(pdf)) if one else np.flatnonzero(pdf["home"] == pdf["low"])
        right = left if one else np.flatnonzero(pdf["home"] == pdf["high"])
        counts = np.zeros(len(pdf), dtype=np.int64)
        for a in range(0, len(left), 1024):
            at = left[a:a + 1024]
            close = (x[at] @ x[right].T >= min_cosine) & (part[at][:, None] == part[right][None, :])
            if one:
                close &= at[:, None] < right[None, :]
            counts[at] += close @ size[right]
            counts[right] += close.T @ size[at]
        keep = counts > 0
        return pd.DataFrame({"node": node[keep], "links": counts[keep]})
    return run


def _links(nodes: DataFrame, roots: DataFrame, min_cosine: float, block: int) -> DataFrame:
    """The links of each node with all others of its component: (node, links).

    The nodes in order of component are cut into blocks of fixed size; a
    component is compared block against block, each pair of its blocks a
    task of its own, whatever its size.
    """
    placed = global_order(nodes.drop("keys").join(roots, "node"), ["root", "node"], [], "vec-parts")
    placed = store(placed.withColumn("home", F.floor(F.col("idx") / block)), "vec-blocks")
    # components in more than one block: no more than there are blocks, which bounds their broadcast
    wide = (placed.groupBy("root").agg(F.min("home").alias("from"), F.max("home").alias("to"))
            .filter(F.col("from") < F.col("to")))
    dealt = placed.join(F.broadcast(wide), "root", "left").withColumn("other", F.explode(F.sequence(
        F.coalesce("from", "home"), F.coalesce("to", "home"))))
    dealt = dealt.select("node", "size", "vector", "root", "idx", "home", F.least("home", "other").alias("low"),
                         F.greatest("home", "other").alias("high"))
    counted = store(dealt.groupBy("low", "high").applyInPandas(_count(min_cosine), "node long, links long"), "vec-links")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE, passes: int = PASSES, bits: int = BITS,
                 window: int = WINDOW, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """Link vectors of one label whose cosine is at least ``min_cosine``, found in sorted projection passes.

    Equal vectors of a label collapse to one node first. Each pass sorts all
    nodes by (label, concatenated signs of ``bits`` random projections),
    equal keys in an order drawn anew for the pass; a node is compared, in
    double precision, with the ``window`` nodes after it. The order is cut
    into blocks of fixed size that overlap by the window, so a large group
    of near copies is spread over many tasks. A block gives a forest of its
    links, never its pairs. Components are the union over all passes. Links
    are then counted between all nodes of a component (:func:`_links`), so a
    dense group that fills the windows loses none; a link is missed only if
    no pass joins the components of its ends. That work grows with the
    square of a component's size.

    Vectors that are null, empty, zero, or hold null or non-finite
    components, or have a null label, link with nothing. Vectors of
    different length do not link. Rows equal in id are told apart by row
    number; a component's id is its smallest vec_id (null ids are passed over).
    No rows: no rows. Extra columns are ignored.

    Returns vec_id, n_links, component_id, kept.
    """
    v = F.col("vector")
    rows = store(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                                F.col(vector_col).cast("array<double>").alias("vector"),
                                F.monotonically_increasing_id().alias("uid")), "vec-rows")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & \
        F.coalesce(F.exists(v, lambda e: e != 0), F.lit(False))
    exact = F.transform(v, lambda e: e + F.lit(0.0))                 # -0.0 and 0.0 are equal
    keyed = rows.withColumn("same", F.when(usable, F.sha2(F.concat_ws(",", F.col("label").cast("string"),
                                                                     F.transform(exact, lambda e: e.cast("string"))), 256)))
    groups = keyed.filter(F.col("same").isNotNull()).groupBy("same").agg(F.min("uid").alias("node"),
                                                                         F.count("*").alias("size"))
    members = store(keyed.select("vec_id", "uid", "same").join(groups, "same", "left")
                    .select("vec_id", "uid", F.coalesce("node", "uid").alias("node"),
                            F.coalesce("size", F.lit(1)).alias("size"), F.col("same").isNotNull().alias("usable")),
                    "vec-members")
    nodes = rows.join(members.filter(F.col("usable") & (F.col("uid") == F.col("node"))).select("uid", "size"), "uid")
    nodes = store(nodes.select(F.col("uid").alias("node"), "size", "label", "vector")
                  .mapInPandas(_keys(passes, bits), "node long, size long, label long, vector array<double>, "
                                                    "keys array<long>"), "vec-nodes")
    order = global_order(nodes.select("node", "label", F.posexplode("keys").alias("pass", "key"))
                         .withColumn("draw", F.xxhash64("node", "pass")),
                         ["pass", "label", "key", "draw"], [], "vec-order")
    order = store(order.select("node", "pass", "idx"), "vec-places")
    dealt = nodes.drop("keys", "size").join(order, "node")
    # a row belongs to its block, and to the blocks before as long as their windows reach it
    reach = -(-window // block)
    home = F.floor(F.col("idx") / block)
    first = F.greatest(F.lit(0).cast("long"), home - reach)
    dealt = dealt.withColumn("block", F.explode(F.sequence(first, home))).withColumn("own", F.col("block") == home)
    dealt = dealt.filter("own" if not window else (F.col("own") | (F.col("idx") < (F.col("block") + 1) * block + window)))
    out = store(dealt.groupBy("pass", "block").applyInPandas(
        _compare(window, min_cosine), "node long, other long"), "vec-forest")
    roots = components(out.select(F.col("node").alias("a"), F.col("other").alias("b")), "vec")
    links = _links(nodes, roots, min_cosine, block)
    full = store(members.join(links, "node", "left")
                 .join(roots.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node")),
                 "vec-full")
    lowest = full.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return (full.join(lowest, "root").select(
        "vec_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")))


def op6_projection_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_vectors(table(spark, sf_dir, "embeddings"))
