"""Near-duplicate embeddings by product quantisation.

Unit vectors are dealt to coarse inverted lists; what is left after the list's centre is coded by one byte per subspace. A vector
probes its own list and every list whose border is near enough to hold a link (below). In a list the distance to a coded vector is
a sum of table look-ups (asymmetric: the probing vector is not coded); the coding error of each vector is known, so a pair
whose look-up distance exceeds the link radius by more than that error cannot be a link, and the sum stops early where its first
subspaces show that. The rest gets its exact cosine.

Probes: vectors at cosine ``t`` are ``r = sqrt(2 - 2t)`` apart at most. If y lies in list j and x in list i, the plane between the
two centres is no farther from x than the shadow of x - y on the line of the centres, which is at most r, and for a difference
without preferred direction in d dimensions about r / sqrt(d). ``sigmas`` = 4 probes lists whose plane is within 4 of
these (a link at the very threshold escapes with probability below 2e-5); ``sigmas=None`` probes up to r and finds all.
The coded search itself loses nothing: its bound is a proof. :func:`brute_force` measures recall in the tests.

Scale: equal vectors fold into one class before anything else, so copies cost one vector. Lists grow in number with the vectors
(``LIST_ROWS`` each, up to ``MAX_LISTS``); a list is dealt into blocks of ``BLOCK`` vectors and its probing vectors likewise, and a pair
of blocks is one unit of work, so neither a long list nor a popular one meets in one task. A unit returns a row per linked vector
(links counted, smallest class linked there), never pairs. Links inside one group of unlike near copies are counted
by comparing its blocks with each other, quadratic in the group but never emitted. The index (centres, codebooks) is fitted on at
most ``FIT_ROWS`` vectors or ``FIT_VALUES`` numbers, chosen by hash; every vector is indexed and compared.

Edge cases: vectors that are null, empty, zero or hold a null or non-finite component link with nothing and stand alone. Vectors of
different lengths never link. Equal vectors link with each other (0.0 and -0.0 are equal). Magnitudes do not matter: vectors are
scaled before they are squared. Repeated ``vec_id`` rows each get a row. Rows without id take part; they name no component (a component
of nothing else has a null id). Empty tables give no rows. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm.components import components, shared_checkpoint
from prelaunch.llm.ngram_join import smallest_linked

THRESHOLD = 0.9
LIST_ROWS = 2048
MAX_LISTS = 4096
BLOCK = 2048
FIT_ROWS = 1 << 15
FIT_VALUES = 1 << 22
SUBSPACE = 4                 # dimensions per code byte, for vectors of up to SUBSPACE * MAX_CODES dimensions
MAX_CODES = 64
CODES = 256
SIGMAS = 4.0
SLACK = 1e-3                 # above the rounding of look-up sums in single precision
STRIP = 256


def usable(vector: Column) -> Column:
    """Not null, all components finite, not all zero."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def positive_zeros(vector: Column, element: str) -> Column:
    return F.transform(vector, lambda x: x + F.lit(0).cast(element))


def matrices(column, kind: type = np.float64) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, vectors as ``kind``) for each vector length of an Arrow list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = []
    for dim in np.unique(width).tolist():
        rows = np.flatnonzero(width == dim)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(kind)
        out.append((int(dim), rows, flat.reshape(len(rows), int(dim))))
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def nearest(x: np.ndarray, centres: np.ndarray, strip: int = 1024) -> np.ndarray:
    half = (centres * centres).sum(1) / 2
    return np.concatenate([np.zeros(0, np.int64), *[(half - x[i: i + strip] @ centres.T).argmin(1) for i in range(0, len(x), strip)]])


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 42) -> np.ndarray:
    """At most k centres of x; an emptied centre keeps its place."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


@dataclass
class Index:
    """Centres of the lists and, per subspace (first, last dimension), the codebook of the residuals."""
    centres: np.ndarray
    books: list[tuple[int, int, np.ndarray]]

    @staticmethod
    def fit(u: np.ndarray, lists: int) -> Index:
        centres = kmeans(u, lists)
        rest = u - centres[nearest(u, centres)]
        dim = u.shape[1]
        cuts = np.linspace(0, dim, min(MAX_CODES, -(-dim // SUBSPACE)) + 1).astype(int).tolist()
        return Index(centres, [(a, b, kmeans(rest[:, a:b], CODES)) for a, b in zip(cuts, cuts[1:])])

    @staticmethod
    def blank(dim: int) -> Index:
        """One list and one code, for lengths that the fitted sample does not hold: nothing is pruned, nothing is lost."""
        return Index(np.zeros((1, dim)), [(0, dim, np.zeros((1, dim)))])

    def encode(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and coding error of each unit vector."""
        own = nearest(u, self.centres)
        rest = u - self.centres[own]
        codes = np.zeros((len(u), len(self.books)), np.uint8)
        for m, (a, b, book) in enumerate(self.books):
            codes[:, m] = nearest(rest[:, a:b], book)
            rest[:, a:b] -= book[codes[:, m]]
        return own, codes, np.sqrt((rest * rest).sum(1))

    def probes(self, u: np.ndarray, own: np.ndarray, reach: float) -> list[np.ndarray]:
        """Per unit vector the lists from its own on whose border is within ``reach``. Every two lists meet once: the vectors
        of the one with the smaller number probe the other."""
        square = (self.centres * self.centres).sum(1)
        apart = np.sqrt(np.maximum(square[own][:, None] + square[None, :] - 2 * self.centres[own] @ self.centres.T, 0))
        far = square[None, :] - 2 * u @ self.centres.T
        beyond = far - far[np.arange(len(u)), own][:, None]
        near = beyond <= 2 * apart * reach + 1e-9
        near &= np.arange(len(self.centres))[None, :] >= own[:, None]
        near[np.arange(len(u)), own] = True
        return [np.flatnonzero(row).astype(np.int32) for row in near]

    def lookups(self, u: np.ndarray, at: int, codes: np.ndarray, most: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(rows, d): squared distances d of coded vectors of list ``at`` (row by row) to unit vectors. With ``most``, a bound for each
        coded vector, rows that exceed it for all of ``u`` are left out as soon as the subspaces summed so far show it."""
        rest = u - self.centres[at]
        rows, total = np.arange(len(codes)), np.zeros((len(codes), len(u)), np.float32)
        half = len(self.books) // 2
        for m, (a, b, book) in enumerate(self.books):
            part = rest[:, a:b]
            table = (book * book).sum(1)[:, None] - 2 * book @ part.T + (part * part).sum(1)[None, :]
            total += table.astype(np.float32)[codes[rows, m]]
            if most is not None and m >= half and (m - half) % 4 == 0:
                alive = (total <= most[rows, None]).any(1)
                if 4 * alive.sum() < 3 * len(rows):
                    rows, total = rows[alive], total[alive]
        return rows, total


def link_block(index: Index, at: int, q: np.ndarray, q_id: np.ndarray, q_w: np.ndarray, x: np.ndarray, x_id: np.ndarray, x_w: np.ndarray,
               codes: np.ndarray, error: np.ndarray, own: np.ndarray, threshold: float, checked: list | None = None) -> tuple:
    """Links of probing vectors ``q`` with the vectors ``x`` of list ``at``: what each side's links weigh (for ``x`` only those from
    other lists: inside a list both ways are looked at), and index pairs. ``checked`` gets the numbers of exact cosines."""
    radius = (math.sqrt(max(2 - 2 * threshold, 0)) + error + SLACK) ** 2
    q_n, x_n = np.zeros(len(q), np.int64), np.zeros(len(x), np.int64)
    left, right = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for first in range(0, len(q), STRIP):
        kept, d = index.lookups(q[first: first + STRIP], at, codes, radius)
        near = (d <= radius[kept, None]) & (x_id[kept, None] != q_id[None, first: first + STRIP])
        rows, some = np.flatnonzero(near.any(0)), np.flatnonzero(near.any(1))
        if not len(rows):
            continue
        if checked is not None:
            checked.append(len(rows) * len(some))
        cols = kept[some]
        linked = near[np.ix_(some, rows)].T & (q[first + rows] @ x[cols].T >= threshold)
        q_n[first + rows] += linked @ x_w[cols]
        x_n[cols] += (linked & (own[first + rows] != at)[:, None]).T @ q_w[first + rows]
        i, j = np.nonzero(linked)
        left.append((first + rows[i]).astype(np.int32))
        right.append(cols[j].astype(np.int32))
    return q_n, x_n, np.concatenate(left), np.concatenate(right)


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): ``rows`` has vec_id and the keys k1, k2 of its vector (null where it takes no part); ``classes`` a row per
    distinct vector (cid, w rows, smallest vec_id, k1, k2, v)."""
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    v = F.when(usable(F.col("embedding")), positive_zeros(F.col("embedding"), element))
    rows = vectors.select("vec_id", v.alias("v"))
    keys = [F.when(F.col("v").isNotNull(), k) for k in (F.xxhash64("v"), F.xxhash64(F.lit("second"), "v"))]
    classes = shared_checkpoint(rows.where("v is not null").groupBy("v").agg(F.count("*").alias("w"), F.min("vec_id").alias("least")))
    classes = classes.select(F.monotonically_increasing_id().alias("cid"), "w", "least", keys[0].alias("k1"), keys[1].alias("k2"), "v")
    return rows.select("vec_id", keys[0].alias("k1"), keys[1].alias("k2")), classes


def fit(classes: DataFrame, list_rows: int = LIST_ROWS) -> dict[int, Index]:
    """An index per vector length of a sample of at most ``FIT_ROWS`` vectors and ``FIT_VALUES`` numbers."""
    n, dim = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return {}
    lists = max(1, min(MAX_LISTS, n // list_rows))
    sample = classes.orderBy("k1", "k2").limit(max(1, min(FIT_ROWS, FIT_VALUES // dim))).select("v").toArrow()
    return {d: Index.fit(unit(x), lists) for d, _, x in matrices(sample.column("v"))}


def links(classes: DataFrame, indexes: dict[int, Index], threshold: float = THRESHOLD, sigmas: float | None = SIGMAS, block: int = BLOCK) -> DataFrame:
    """(cid, n, to): per linked class and unit of work the rows it is linked with there and the smallest class linked there."""
    kind = classes.schema["v"].dataType.simpleString()

    def encode(batches):
        for batch in batches:
            for dim, rows, x in matrices(batch.column("v")):
                index = indexes.get(dim) or Index.blank(dim)
                reach = math.sqrt(max(2 - 2 * threshold, 0)) * (1 if sigmas is None else min(1, sigmas / math.sqrt(dim)))
                for i in range(0, len(rows), 512):
                    some = pa.array(rows[i: i + 512])
                    u = unit(x[i: i + 512])
                    own, codes, error = index.encode(u)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("cid").take(some), batch.column("w").take(some), pa.array(np.full(len(u), dim, np.int32)), pa.array(own.astype(np.int32)),
                         pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(index.probes(u, own, reach), pa.list_(pa.int32())),
                         batch.column("v").take(some)], ["cid", "w", "dim", "own", "code", "error", "probes", "v"])

    coded = shared_checkpoint(classes.select("cid", "w", "v").mapInArrow(
        encode, f"cid long, w long, dim int, own int, code binary, error double, probes array<int>, v {kind}"))
    asked = coded.select("dim", F.explode("probes").alias("list")).groupBy("dim", "list").agg(F.count("*").alias("asked"))
    held = coded.groupBy("dim", F.col("own").alias("list")).agg(F.count("*").alias("held"))
    # a row per list: into how many blocks its vectors and those that probe it are dealt
    sizes = shared_checkpoint(held.join(asked, ["dim", "list"]).select(
        "dim", "list", F.ceil(F.col("held") / block).cast("int").alias("blocks"), F.ceil(F.col("asked") / block).cast("int").alias("salts")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "cid"), F.col(n)).cast("int")
    probing = (coded.select("cid", "w", "dim", "own", "v", F.explode("probes").alias("list")).join(sizes, ["dim", "list"])
               .withColumn("salt", deal("salts", 1)).withColumn("block", every("blocks")).drop("blocks", "salts"))
    lists = (coded.select("cid", "w", "dim", F.col("own").alias("list"), "code", "error", "v").join(sizes, ["dim", "list"])
             .withColumn("block", deal("blocks", 2)).withColumn("salt", every("salts")).drop("blocks", "salts"))
    nothing = pa.table({"cid": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "to": pa.array([], pa.int64())})

    def run(key: tuple, asking: pa.Table, held: pa.Table) -> pa.Table:
        if not len(asking) or not len(held):
            return nothing
        dim, at = key[0].as_py(), key[1].as_py()
        index = indexes.get(dim) or Index.blank(dim)
        (_, _, q), (_, _, x) = matrices(asking.column("v"))[0], matrices(held.column("v"))[0]
        q_id, x_id = asking.column("cid").to_numpy(), held.column("cid").to_numpy()
        codes = np.frombuffer(b"".join(held.column("code").to_pylist()), np.uint8).reshape(len(held), len(index.books))
        q_n, x_n, left, right = link_block(index, at, unit(q), q_id, asking.column("w").to_numpy(), unit(x), x_id, held.column("w").to_numpy(),
                                           codes, held.column("error").to_numpy(), asking.column("own").to_numpy(), threshold)
        if not len(left):
            return nothing
        root = smallest_linked(len(q) + len(x), left, right.astype(np.int64) + len(q))
        ids, n = np.concatenate([q_id, x_id]), np.concatenate([q_n, x_n])
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, root, ids)
        some = np.unique(np.concatenate([left, right.astype(np.int64) + len(q)]))
        return pa.table({"cid": ids[some], "n": n[some], "to": least[root[some]]})

    keys = ["dim", "list", "block", "salt"]
    # both sides come from one table: columns of their own
    probing, lists = probing.toDF(*probing.columns), lists.toDF(*lists.columns)
    return probing.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInArrow(run, "cid long, n long, to long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, sigmas: float | None = SIGMAS, list_rows: int = LIST_ROWS,
                    block: int = BLOCK) -> DataFrame:
    """A row per row of ``vectors`` (vec_id, embedding): vec_id, n_links (other rows linked directly), component_id (smallest
    vec_id reachable by links), kept (the row that names its component)."""
    rows, classes = classes_of(vectors)
    found = shared_checkpoint(links(classes, fit(classes, list_rows), threshold, sigmas, block))
    counts = found.groupBy("cid").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("cid").alias("u"), F.col("to").alias("v"))).select(F.col("node").alias("cid"), "root")
    # only classes of several rows or with links matter from here on
    known = shared_checkpoint(classes.drop("v").join(counts, "cid", "left").join(roots, "cid", "left").where("w > 1 or n is not null")
                              .withColumn("root", F.coalesce("root", "cid")))
    named = known.groupBy("root").agg(F.min("least").alias("component_id"))
    judged = known.join(named, "root").select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    out = rows.join(judged, ["k1", "k2"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))


def brute_force(rows: list[tuple], threshold: float = THRESHOLD) -> list[tuple]:
    """Reference for tests: (vec_id, n_links, component_id, kept) by comparing all pairs."""
    def good(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        a, b = ([x / max(map(abs, v)) for x in v] for v in (a, b))
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))

    n = len(rows)
    parent, count = list(range(n)), [0] * n

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if good(a) and good(b) and len(a) == len(b) and cosine(a, b) >= threshold:
                count[i] += 1
                count[j] += 1
                parent[top(i)] = top(j)
    least: dict = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[top(i)] = min(k, least.get(top(i), k))
    return [(k, count[i], least.get(top(i)), k == least.get(top(i))) for i, (k, _) in enumerate(rows)]


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`near_duplicates` over all embeddings."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS i, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.i, a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.i <> b.i AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
counted AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON least.u = e.vec_id LEFT JOIN counted ON counted.u = e.vec_id
"""
