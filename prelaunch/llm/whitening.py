"""Embedding whitening from a weighted covariance over distinct vectors.

Entries become integers x; equal x-vectors are one class with the number of its rows as weight. Two passes over the classes fit the
model: exact sums per dimension, then the weighted product of the centred vectors (each task multiplies its own, the d x d
products are merged in a tree). The eigenvectors of that covariance whiten every class once, and the rows are joined back to it.

Scale: rows shuffle once to be counted (with map-side combine, so a vector repeated a billion times is one row a task) and once to be
joined back, then as two hashes and an id; a hot class is split by adaptive execution (skew join). A covariance is cut into
strips of ``STRIP`` rows, and a merge task holds ``FAN_IN`` strips, whatever the number of tasks. The driver sees the
sums (d), the covariance (d x d) and 36 moments of the whitened classes, for every vector length.

Weights: ``weights="counts"`` fits on all rows; ``weights="one"`` on each distinct vector once.

Edge cases: vectors that are null or hold a null or non-finite entry are dropped, empty ones have no components. Vectors of different
lengths are fitted apart, each length with its own ``n``. Entries are held within +-4e18 / 1024, so that x is a long. A deviation that no
long can hold is null. A component without variance (a constant table, one row, fewer independent vectors than components) has a
null ``whitened`` and counts for no error; without any variance ``explained`` is null, too. Of equal eigenvalues any basis may come.
Repeated rows and ids and null ids each get their rows. Empty tables give no rows. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm.components import shared_checkpoint
from prelaunch.llm.embedding_dedup import matrices

COMPONENTS = 8
STRIP = 64
FAN_IN = 32
LARGEST = 4e18
NO_VARIANCE = 1e-13          # of the largest eigenvalue


def whole_numbers(vector: Column) -> Column:
    """floor(1024 * c) + 100000 of every entry as long; null where an entry is null or not finite."""
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    held = lambda c: F.greatest(F.least(c.cast("double") * 1024, F.lit(LARGEST)), F.lit(-LARGEST))
    return F.when(fine, F.transform(vector, lambda c: F.floor(held(c)).cast("long") + 100000))


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S exactly: as longs where they fit, else as Python integers."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if most < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def deviations(t: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows, exact; None beyond a long."""
    if t.dtype != object and (int(np.abs(t).max(initial=0)) + 1) ** 2 * t.shape[1] < 1 << 63:
        return (t * t).sum(1).tolist()
    out = [sum(v * v for v in row) for row in t.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): vec_id and the keys k1, k2 of its x-vector; and per distinct x-vector its keys and number of rows w."""
    rows = vectors.select("vec_id", whole_numbers(F.col("embedding")).alias("x")).where("x is not null")
    keys = [F.xxhash64("x").alias("k1"), F.xxhash64(F.lit("second"), "x").alias("k2")]
    classes = shared_checkpoint(rows.groupBy("x").agg(F.count("*").alias("w")))
    return rows.select("vec_id", *keys), classes.select(*keys, "w", "x")


def dimension_sums(classes: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per vector length the weight n and the exact weighted sum of each dimension."""

    def run(batches):
        for batch in batches:
            w_all = batch.column("w").to_numpy()
            for dim, rows, x in matrices(batch.column("x"), np.int64):
                w, n = w_all[rows], int(w_all[rows].sum())
                small = int(np.abs(x).max(initial=0)) * n < 1 << 62
                sums = (w @ x if small else w.astype(object) @ x.astype(object)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * (dim + 1), pa.int32()), pa.array(range(-1, dim), pa.int32()), pa.array([str(v) for v in [n, *sums]])], ["dim", "at", "v"])

    found = classes.select("w", "x").mapInArrow(run, "dim int, at int, v string")
    found = found.groupBy("dim", "at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    out: dict[int, dict] = {}
    for r in found:
        out.setdefault(r["dim"], {})[r["at"]] = int(r["v"])
    return {dim: (v[-1], [v[i] for i in range(dim)]) for dim, v in out.items()}


def covariances(classes: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """Per vector length the covariance, divisor n, of the centred vectors."""

    def products(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            w_all = batch.column("w").to_numpy()
            for dim, rows, x in matrices(batch.column("x"), np.int64):
                n, s = sums[dim]
                for i in range(0, len(rows), 4096):
                    c = centred(x[i: i + 4096], n, s).astype(np.float64) / n
                    held[dim] = held.get(dim, 0) + c.T @ (c * w_all[rows[i: i + 4096], None])
        part = TaskContext.get().partitionId()
        for dim, g in held.items():
            for first in range(0, dim, STRIP):
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([first], pa.int32()), pa.array([part], pa.int32()),
                                                  pa.array([g[first: first + STRIP].tobytes()], pa.binary())], ["dim", "strip", "part", "g"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(g, np.float64) for g in table.column("g").to_pylist())
        return pa.table({"dim": [key[0]], "strip": [key[1]], "part": [key[2]], "g": pa.array([total.tobytes()], pa.binary())})

    strips = classes.select("w", "x").mapInArrow(products, "dim int, strip int, part int, g binary")
    parts = classes.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // FAN_IN)
        strips = strips.groupBy("dim", "strip", F.floor(F.col("part") / FAN_IN).cast("int").alias("up")).applyInArrow(
            merge, "dim int, strip int, part int, g binary")
    out = {dim: np.zeros((dim, dim)) for dim in sums}
    for r in strips.collect():
        got = np.frombuffer(r["g"], np.float64).reshape(-1, r["dim"]) if r["dim"] else np.zeros((0, 0))
        out[r["dim"]][r["strip"]: r["strip"] + len(got)] += got / sums[r["dim"]][0]
    return out


@dataclass
class Whitening:
    """For vectors of one length: weight and sums of the fit, unit eigenvectors as columns, their eigenvalues, shares of the trace."""
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: list[float | None]

    @staticmethod
    def of(n: int, sums: list[int], covariance: np.ndarray, components: int) -> Whitening:
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2) if len(sums) else (np.zeros(0), np.zeros((0, 0)))
        values, vectors = np.maximum(values[::-1][:components], 0), vectors[:, ::-1][:, :components]
        # one sign for all rows: the largest loading is positive
        at = np.abs(vectors).argmax(0) if len(sums) else []
        vectors = vectors * np.sign(vectors[at, range(len(values))]) if len(sums) else vectors
        trace = float(np.trace(covariance))
        return Whitening(n, sums, vectors, values, [float(e) / trace if trace > 0 else None for e in values])

    def whiten(self, t: np.ndarray) -> np.ndarray:
        """Whitened coordinates of exact n * x - S; NaN for a component without variance."""
        z = (t.astype(np.float64) / self.n) @ self.vectors
        some = self.values > NO_VARIANCE * self.values[:1]
        return np.where(some, z / np.sqrt(np.where(some, self.values, 1)), np.nan)


def fit(classes: DataFrame, components: int = COMPONENTS, weights: str = "counts") -> dict[int, Whitening]:
    """A whitening per vector length of ``classes`` (see :func:`classes_of`)."""
    if weights not in ("counts", "one"):
        raise ValueError("weights are 'counts' or 'one'")
    if weights == "one":
        classes = classes.withColumn("w", F.lit(1).cast("long"))
    sums = dimension_sums(classes)
    found = covariances(classes, sums)
    return {dim: Whitening.of(n, s, found[dim], components) for dim, (n, s) in sums.items()}


def whitened_classes(classes: DataFrame, model: dict[int, Whitening]) -> DataFrame:
    """(k1, k2, w, dim, n, deviation, z, explained): every class whitened once."""

    def run(batches):
        for batch in batches:
            for dim, rows, x in matrices(batch.column("x"), np.int64):
                m = model[dim]
                for i in range(0, len(rows), 4096):
                    some = pa.array(rows[i: i + 4096])
                    t = centred(x[i: i + 4096], m.n, m.sums)
                    z = m.whiten(t)
                    values = pa.array(z.ravel(), from_pandas=True)       # NaN becomes null
                    width = z.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).take(some) for c in ("k1", "k2", "w")] + [
                            pa.array([dim] * len(z), pa.int32()), pa.array([m.n] * len(z), pa.int64()), pa.array(deviations(t), pa.int64()),
                            pa.ListArray.from_arrays(pa.array(range(0, width * len(z) + 1, width) if width else [0] * (len(z) + 1), pa.int32()), values.cast(pa.float64())),
                            pa.array([m.explained] * len(z), pa.list_(pa.float64()))],
                        ["k1", "k2", "w", "dim", "n", "deviation", "z", "explained"])

    return classes.mapInArrow(run, "k1 long, k2 long, w long, dim int, n long, deviation long, z array<double>, explained array<double>")


def identity_errors(done: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(dim, identity_error): the largest absolute entry of the whitened vectors' covariance minus the identity, measured on the
    whitened classes by their weights."""
    z = lambda i: F.get("z", F.lit(i))
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    means = done.groupBy("dim").agg(*[(F.sum(F.col("w") * z(i)) / F.sum("w")).alias(f"m{i}") for i in range(components)])
    # centred before multiplying; the means are one row per vector length
    off = done.join(means, "dim")
    c = lambda i: z(i) - F.col(f"m{i}")
    entry = lambda i, j: F.abs(F.sum(F.col("w") * c(i) * c(j)) / F.sum("w") - (1.0 if i == j else 0.0))
    found = off.groupBy("dim").agg(*[entry(i, j).alias(f"e{i}_{j}") for i, j in pairs])
    return found.select("dim", F.greatest(*[F.col(f"e{i}_{j}") for i, j in pairs]).alias("identity_error"))


def whiten(vectors: DataFrame, components: int = COMPONENTS, weights: str = "counts") -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding) with a usable vector and component: vec_id, component (from 1), n, deviation,
    whitened, explained, identity_error."""
    rows, classes = classes_of(vectors)
    done = shared_checkpoint(whitened_classes(classes, fit(classes, components, weights)))
    errors = identity_errors(done if weights == "counts" else done.withColumn("w", F.lit(1)), max(components, 2))
    done = done.join(errors, "dim", "left").select("k1", "k2", "n", "deviation", "z", "explained", "identity_error")
    joined = rows.join(done, ["k1", "k2"])
    out = joined.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("z").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                      F.get("explained", F.col("at")).alias("explained"), "identity_error")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`whiten` over all embeddings, weighted by their copies."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
