"""Operator 11: whitening of embeddings by incremental eigendecomposition."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, store, table

COMPONENTS = 4
SCALE = 256              # entries are counted in 1/256, floored
FAN_IN = 32              # spectra combined in one task
BLOCK_CELLS = 1 << 19    # numbers in a block of rows that a partition adds at once


def whole_vectors(df: DataFrame, vector_col: str, scale: int = SCALE) -> DataFrame:
    """Rows whose vector has no null and no non-finite entry, with ``x``: its entries times ``scale``, floored."""
    v = F.col(vector_col)
    finite = ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.filter(v.isNotNull() & finite).withColumn(
        "x", F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("long")))


def _rows(batch, dim: int):
    """The x-vectors of an Arrow batch as a matrix of longs."""
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _blocks(batches, dim: int, rows: int):
    import numpy as np
    held, n = [], 0
    for batch in batches:
        x = _rows(batch, dim)
        held.append(x)
        n += len(x)
        if n >= rows:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def _spectrum_of_partition(dim: int, block: int):
    """One row a partition: its packed spectrum, and its exact sums in two halves of 32 bits."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from .spectra import Spectrum
        state = Spectrum.empty(dim)
        high, low = np.zeros(dim, dtype=np.int64), np.zeros(dim, dtype=np.int64)
        for x in _blocks(batches, dim, block):
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            state.add_block(x.astype(np.float64))
        if state.n:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int64()),
                "flat": pa.array([state.pack()], pa.list_(pa.float64())),
                "high": pa.array([high.tolist()], pa.list_(pa.int64())),
                "low": pa.array([low.tolist()], pa.list_(pa.int64()))})
    return run


def _combined(flats) -> list[float]:
    from .spectra import Spectrum
    it = iter(flats)
    state = Spectrum.unpack(next(it))
    for flat in it:
        state.combine(Spectrum.unpack(flat))
    return state.pack()


def _added(flats) -> list[float]:
    import numpy as np
    return np.sum([np.asarray(f, dtype=np.float64) for f in flats], axis=0).tolist()


def tree(parts: DataFrame, fold: Callable, name: str, fan_in: int = FAN_IN) -> list[float] | None:
    """Fold the packed states (part, flat) of all partitions, ``fan_in`` a task and level after level.

    The order within a task is that of the part numbers, so reruns over the same
    partitions agree. Every level is stored; the driver gets the last state.
    """
    parts = parts.select("part", "flat")
    while parts.count() > 1:
        def level(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("part", kind="stable")
            return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // fan_in], "flat": [fold(pdf["flat"])]})
        parts = store(parts.groupBy(F.floor(F.col("part") / fan_in).alias("g")).applyInPandas(
            level, "part long, flat array<double>"), f"{name}-level")
    last = parts.first()
    return list(last["flat"]) if last else None


def _partial(dim: int, make: Callable):
    """One row a partition: the sum of ``make(block)`` over its blocks."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        total = None
        for x in _blocks(batches, dim, max(1, BLOCK_CELLS // dim)):
            part = make(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              "flat": pa.array([total.tolist()], pa.list_(pa.float64()))})
    return run


@dataclass
class Whitener:
    """What whitening needs: fit size, exact sums, leading unit eigenvectors (columns), eigenvalues, trace."""

    n: int
    sums: list[int]
    vectors: object
    values: object
    trace: float
    identity_error: float | None

    @property
    def dim(self) -> int:
        return len(self.sums)

    def mean(self):
        import numpy as np
        return np.array([s / self.n for s in self.sums])

    def usable(self):
        """Components with spread; the others cannot be scaled to one."""
        import numpy as np
        top = float(self.values[0]) if len(self.values) else 0.0
        return np.asarray(self.values) > self.dim * np.finfo(np.float64).eps * top

    def project(self, x):
        """Whitened components of x-vectors (NaN where a component has no spread)."""
        import numpy as np
        good = self.usable()
        y = np.full((len(x), len(self.values)), np.nan)
        y[:, good] = ((x - self.mean()) @ self.vectors[:, good]) / np.sqrt(np.asarray(self.values)[good])
        return y

    def deviations(self, x) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, exact; None beyond a long."""
        import numpy as np
        most = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums))
        if most * most * self.dim < 1 << 62:
            off = x * self.n - np.array(self.sums, dtype=np.int64)
            return (off * off).sum(axis=1).tolist()
        exact = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x]
        return [d if d < 1 << 63 else None for d in exact]


def fit_whitener(fit: DataFrame, dim: int, components: int = COMPONENTS, block: int | None = None) -> Whitener | None:
    """Eigenpairs of the covariance of the stored list ``fit`` (column x: ``dim`` longs); None if it is empty.

    1. Every partition keeps a spectrum (:mod:`.spectra`) by centred rank-one updates, blocks of ``block`` rows
       at a time. 2. Spectra are combined in a tree of tasks by successive
       rank-one updates. 3. Rayleigh-Ritz: a distributed pass multiplies the centred
       list with the combined basis; the small matrix of products corrects the
       basis and gives the eigenvalues. 4. A last pass measures the covariance of the whitened list.
    The driver and closures hold matrices of dim x dim numbers, whatever the rows.
    """
    import numpy as np
    block = block or max(4 * dim, BLOCK_CELLS // dim)
    parts = store(fit.select("x").mapInArrow(_spectrum_of_partition(dim, block),
                                             "part long, flat array<double>, high array<long>, low array<long>"),
                  "whiten-parts")
    flat = tree(parts, _combined, "whiten-spectrum")
    if flat is None:
        return None
    from .spectra import Spectrum
    state = Spectrum.unpack(flat)
    big = "decimal(38,0)"
    halves = (parts.select(F.posexplode(F.arrays_zip("high", "low")).alias("d", "s"))
              .groupBy("d").agg(F.sum(F.col("s.high").cast(big)).alias("high"), F.sum(F.col("s.low").cast(big)).alias("low"))
              .collect())                                              # a row a dimension
    sums = [0] * dim
    for r in halves:
        sums[r["d"]] = (int(r["high"]) << 32) + int(r["low"])
    mean = np.array([s / state.n for s in sums])
    # a whole orthonormal basis: held directions first, the rest without spread
    basis = np.linalg.qr(np.column_stack([state.vectors[:, ::-1], np.eye(dim)]))[0][:, :dim]

    def products(x):
        y = (x - mean) @ basis
        return (y.T @ y).ravel()

    passed = "part long, flat array<double>"
    small = np.array(tree(store(fit.select("x").mapInArrow(_partial(dim, products), passed), "whiten-ritz"),
                          _added, "whiten-ritz")).reshape(dim, dim) / state.n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    keep = np.argsort(values, kind="stable")[::-1][:components]
    vectors = basis @ turn[:, keep]
    vectors /= np.linalg.norm(vectors, axis=0)
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))] < 0, -1.0, 1.0)
    out = Whitener(state.n, sums, vectors, np.maximum(values[keep], 0.0), float(np.trace(small)), None)

    good = out.usable()
    if good.any():
        k = int(good.sum())

        def moments(x):
            w = out.project(x)[:, good]
            return np.concatenate([[float(len(w))], w.sum(axis=0), (w.T @ w).ravel()])

        m = np.array(tree(store(fit.select("x").mapInArrow(_partial(dim, moments), passed), "whiten-check"),
                          _added, "whiten-check"))
        centre = m[1:1 + k] / m[0]
        cov = m[1 + k:].reshape(k, k) / m[0] - np.outer(centre, centre)
        out.identity_error = float(np.abs(cov - np.eye(k)).max())
    return out


def _whitened(fit: Whitener):
    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        k = len(fit.values)
        good = fit.usable()
        share = [float(v) / fit.trace if fit.trace > 0 else None for v in fit.values]
        for batch in batches:
            x = _rows(batch, fit.dim)
            rows = len(x)
            y = fit.project(x).ravel()
            times = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(batch.schema.get_field_index("vec_id")).take(pa.array(times)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows), pa.int32()),
                "n": pa.array(np.full(rows * k, fit.n, dtype=np.int64)),
                "deviation": pa.array(fit.deviations(x), pa.int64()).take(pa.array(times)),
                "whitened": pa.array(y, pa.float64(), mask=np.tile(~good, rows)),
                "explained": pa.array(share * rows, pa.float64()),
                "identity_error": pa.array([fit.identity_error] * (rows * k), pa.float64())})
    return run


def whiten(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", components: int = COMPONENTS,
           scale: int = SCALE, block: int | None = None) -> DataFrame:
    """Leading whitened components of every vector, fitted on the distinct scaled vectors.

    Vectors are filtered, scaled and floored by SQL functions. The fit list
    (each distinct vector once) is reduced in every task before the shuffle,
    so a hot vector arrives once a task; it is stored and fitted by
    :func:`fit_whitener`. Vectors shorter than the longest are filled up with zeros.

    Null vectors and those with null or non-finite entries are dropped; an
    empty vector counts as zeros. Null ids are kept. Repeated rows each get
    their rows. A component without spread (all vectors equal, or fewer
    vectors than components) has ``whitened`` null; ``identity_error`` is over the others, null
    without any. ``deviation`` is null beyond a long; entries beyond a long are cut to it.
    No vectors, or none with an entry: no rows. Extra columns, also of the names used here, are ignored.

    Returns vec_id, component, n, deviation, whitened, explained, identity_error.
    """
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    kept = whole_vectors(df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")),
                         "v", scale).select("vec_id", "x")
    dim = kept.agg(F.max(F.size("x"))).first()[0] or 0
    if dim == 0:
        return df.sparkSession.createDataFrame([], schema)
    filled = kept.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x"))))
    fit = store(filled.select("x").distinct(), "whiten-fit")
    return filled.mapInArrow(_whitened(fit_whitener(fit, dim, components, block)), schema)


def op11_rank_one_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return whiten(table(spark, sf_dir, "embeddings"))
