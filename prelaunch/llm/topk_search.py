"""Exact top-k inner-product search without random access.

Every component of the vectors is a list sorted by its contribution to a query's score (from the largest down for a positive
query component, from the smallest up for a negative one). The lists are read sequentially, a stretch of all of them at a
time; what a stretch adds is added to the sums known so far. What has been read of a vector, with the smallest value of the lists it
was not seen in, is a lower bound of its score; with the values the reading has come to, an upper bound. Vectors whose upper bound
is below the k-th largest lower bound cannot qualify. A query stops when few vectors are left (at full depth the bounds
are the scores); only these have their final scores resolved. A block starts reading at half the depth at which its first
query block's earliest query stopped, which changes nothing but the number of stretches.

Scale: candidates are packed into blocks of ``BLOCK`` vectors, queries into blocks of ``QUERIES``; every pair of
blocks is one unit of work. Query blocks are broadcast ``BROADCAST_BYTES`` at a time: a search reads the packed candidates once
for each such part, and moves neither side by shuffle. A unit returns k rows a query; the best k of them are ranked per
query, with the ranking's limit applied before the shuffle. The work grows with queries x vectors, as the stated query set asks
for, and no task holds more than one pair of blocks.

Edge cases: vectors that are null, or hold a null or non-finite component, and rows with a null id take no part.
Components are floor(256 * x). Blocks whose components stay below 2**26 are searched in doubles or longs that hold every sum
exactly; vectors with a larger component are packed apart and scored with integers of any size, so every finite vector takes part. A
returned score beyond a long is an error. Only vectors of equal length are compared (empty ones score 0). Ties go to the
smaller id. A query id is never its own candidate; repeated ids are so excluded together, and a repeated query row gives its ranks
again. Fewer candidates than k give fewer rows. Empty tables give no rows. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prelaunch.llm.components import shared_checkpoint
from prelaunch.llm.embedding_dedup import matrices

K = 5
BLOCK = 4096
QUERIES = 1024
FEW = 64                     # vectors left at which a query is resolved
BROADCAST_BYTES = 32 << 20
LIMIT = float(1 << 26)


def finite(vector: Column) -> Column:
    """The vector as doubles; null where it takes no part."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.when(fine, F.transform(vector, lambda x: x.cast("double")))


def whole(x: float) -> int:
    """floor(256 * x) of a finite double, whatever its size."""
    return math.floor(x * 256) if abs(x) < 1e300 else int(x) * 256


def packed(vectors: DataFrame, size: int) -> DataFrame:
    """(key, dim, wide, n, ids, values): the vectors (vec_id, w_v) of each task in blocks of at most ``size``, of one length
    each: components as 32-bit integers, or where ``wide`` the vectors themselves as doubles."""

    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        held: dict[tuple, list] = {}

        def block(dim, wide, ids, values):
            nonlocal made
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part * (1 << 32) + made]), pa.array([dim], pa.int32()), pa.array([wide]), pa.array([len(ids)], pa.int32()),
                 pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([values.astype("<f8" if wide else "<i4").tobytes()], pa.binary())],
                ["key", "dim", "wide", "n", "ids", "values"])

        for batch in batches:
            all_ids = batch.column("vec_id").to_numpy()
            for dim, rows, x in matrices(batch.column("w_v")):
                with np.errstate(over="ignore"):
                    scaled = np.floor(x * 256)
                far = (np.abs(scaled) >= LIMIT).any(1)
                for wide, some, values in ((False, ~far, scaled), (True, far, x)):
                    ids, values = all_ids[rows[some]], values[some]
                    if (dim, wide) in held:
                        ids, values = np.concatenate([held[dim, wide][0], ids]), np.concatenate([held[dim, wide][1], values])
                    while len(ids) >= size:
                        yield block(dim, wide, ids[:size], values[:size])
                        ids, values = ids[size:], values[size:]
                    if len(ids):
                        held[dim, wide] = (ids, values)
                    else:
                        held.pop((dim, wide), None)
        for (dim, wide), (ids, values) in held.items():
            yield block(dim, wide, ids, values)

    return vectors.mapInArrow(run, "key long, dim int, wide boolean, n int, ids binary, values binary")


class SortedLists:
    """The sorted lists of one block of vectors: values, and each value's place in its list."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x.astype(np.float64)
        order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.x, order, 0)
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(len(x))[:, None], 0)
        self.start = max(1, len(x) // 16)

    def read(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Marks of the entries ``first`` to ``last`` from the large and from the small end of each list."""
        n = len(self.x)
        return (self.place >= n - last) & (self.place < n - first), (self.place < last) & (self.place >= first)


def search_block(lists: SortedLists, qids: np.ndarray, q: np.ndarray, k: int, few: int = FEW):
    """(query number, vec_id, score) of the best k vectors of the block for every query, and the depth each query
    read. Exact: all sums stay below 2**53, else they are made of integers."""
    n, d = lists.x.shape
    bound = (np.abs(lists.x).max(initial=0) + 1) * (np.abs(q).max(initial=0) + 1) * max(d, 1) * 4
    kind = np.float64 if bound < 2 ** 53 else np.int64
    x = lists.x.astype(kind)
    floor = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
    out, depths = [], np.full(len(q), n)
    todo, known, before = np.arange(len(q)), np.zeros((n, len(q)), kind), 0
    depth = max(1, min(n, max(k, lists.start)))
    while len(todo):
        pos, neg = np.maximum(q[todo], 0).astype(kind).T, np.minimum(q[todo], 0).astype(kind).T
        high, low = lists.read(before, depth)
        known += np.where(high, x, 0) @ pos + np.where(low, x, 0) @ neg
        if depth == n:
            lower, upper = known.copy(), known.copy()
        else:
            high, low = (1 - m.astype(kind) for m in lists.read(0, depth))          # not seen yet
            ends = [lists.sorted[i].astype(kind) for i in (0, -1, n - depth, depth - 1)]
            lower = known + high @ (ends[0][:, None] * pos) + low @ (ends[1][:, None] * neg)
            upper = known + high @ (ends[2][:, None] * pos) + low @ (ends[3][:, None] * neg)
        own = lists.ids[:, None] == qids[todo][None, :]
        lower[own] = floor
        upper[own] = floor
        kth = np.partition(lower, n - k, axis=0)[n - k] if n > k else np.full(len(todo), floor)
        left = (upper >= kth) & ~own
        done = (left.sum(0) <= max(few, k)) | (depth == n)
        for c in np.flatnonzero(done).tolist():
            rows = np.flatnonzero(left[:, c])
            score = lists.x[rows].astype(np.int64) @ q[todo[c]].astype(np.int64)    # final scores
            best = np.lexsort((lists.ids[rows], -score))[:k]
            out.append((np.full(len(best), todo[c]), lists.ids[rows[best]], score[best]))
            depths[todo[c]] = depth
        todo, known = todo[~done], known[:, ~done]
        before, depth = depth, min(n, depth * 4)
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), depths
    lists.start = max(lists.start, int(depths.min()) // 2)
    return (*(np.concatenate(c) for c in zip(*out)), depths)


def search_wide(ids: np.ndarray, x: list[list[int]], qids: np.ndarray, q: list[list[int]], k: int):
    """The same for components of any size: every score is resolved, in integers of any size."""
    which, found, scores = [], [], []
    for c, (own, query) in enumerate(zip(qids.tolist(), q)):
        scored = ((sum(a * b for a, b in zip(v, query)), i) for i, v in zip(ids.tolist(), x) if i != own)
        for score, i in sorted(scored, key=lambda s: (-s[0], s[1]))[:k]:
            which.append(c)
            found.append(i)
            scores.append(score)
    return which, found, scores


def search(queries: DataFrame, candidates: DataFrame, k: int = K, block: int = BLOCK, query_block: int = QUERIES,
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``candidates`` for each row of ``queries`` (both vec_id, embedding)."""
    def read(df):
        return df.select("vec_id", finite(F.col("embedding")).alias("w_v")).where("vec_id is not null and w_v is not null")

    qs = shared_checkpoint(packed(read(queries), query_block))
    parts = -(-(qs.agg(F.sum(F.octet_length("values") + F.octet_length("ids"))).first()[0] or 0) // broadcast_bytes)
    xs = packed(read(candidates), block)
    xs = shared_checkpoint(xs) if parts > 1 else xs
    numbered = qs.select(F.col("key").alias("q_key"), "dim", F.col("wide").alias("q_wide"), F.col("ids").alias("q_ids"), F.col("values").alias("q_values"))

    def values(raw, wide, n, dim):
        return np.frombuffer(raw, "<f8" if wide else "<i4").reshape(n, dim)

    def integers(x):
        return [[whole(v) if isinstance(v, float) else v for v in row] for row in x.tolist()]

    def run(batches):
        held, x, lists = None, None, None
        for batch in batches:
            for r in batch.to_pylist():
                if held != r["key"]:
                    held, lists = r["key"], None
                    ids = np.frombuffer(r["ids"], "<i8")
                    x = values(r["values"], r["wide"], len(ids), r["dim"])
                qids = np.frombuffer(r["q_ids"], "<i8")
                q = values(r["q_values"], r["q_wide"], len(qids), r["dim"])
                if r["wide"] or r["q_wide"]:
                    which, vec, score = search_wide(ids, integers(x), qids, integers(q), k)
                else:
                    lists = lists or SortedLists(ids, x)
                    which, vec, score, _ = (v.tolist() for v in search_block(lists, qids, q, k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids[which] if len(which) else [], pa.int64()), pa.array([r["q_key"]] * len(which), pa.int64()), pa.array(which, pa.int32()),
                     pa.array(vec, pa.int64()), pa.array([None if abs(s) >= 1 << 63 else s for s in score], pa.int64()),
                     pa.array([str(s) if abs(s) >= 1 << 63 else None for s in score], pa.string())],
                    ["query_id", "q_key", "q_row", "vec_id", "score", "beyond"])

    schema = "query_id long, q_key long, q_row int, vec_id long, score long, beyond string"
    found = None
    for part in range(max(1, parts)):
        some = numbered if parts <= 1 else numbered.where(F.pmod(F.xxhash64("q_key"), F.lit(parts)) == part)
        got = xs.join(F.broadcast(some), "dim").mapInArrow(run, schema)
        got = shared_checkpoint(got) if parts > 1 else got
        found = got if found is None else found.unionByName(got)
    # scores beyond a long rank by sign, length and digits; one among the k best is an error
    positive = F.coalesce(~F.col("beyond").startswith("-"), F.lit(False))
    size = F.when(F.col("beyond").isNull(), F.lit(0)).otherwise(F.length("beyond") * F.when(positive, 1).otherwise(-1))
    order = Window.partitionBy("query_id", "q_key", "q_row").orderBy(
        size.desc(), F.when(positive, F.col("beyond")).desc_nulls_last(), F.when(~positive, F.col("beyond")).asc_nulls_first(), F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    score = F.when(F.col("beyond").isNull(), F.col("score")).otherwise(F.raise_error(F.concat(F.lit("the score "), "beyond", F.lit(" exceeds a long"))).cast("long"))
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`search` with the rows whose vec_id is divisible by 50 against all rows."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors.where("vec_id % 50 = 0"), vectors)


ORACLE_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum(list_transform(generate_series(1, len(q.w)), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.w) = len(c.w)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
