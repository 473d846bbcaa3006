"""Pairwise-complete moments of many columns from masked Gram matrices (AGG10).

A batch of rows is a matrix X with zeros for its nulls and a matrix M of 0/1 marks. M'M counts the rows on which two columns are
both present, X'M sums the one where the other is present, and X'X their products: three matrix products give what k * (k + 1) / 2
aggregates would. Batches and tasks are merged by the update formula for means and co-moments, which loses no digits to
large offsets. A task hands over one row of four k x k matrices; they are merged in a tree whose fan-in follows
from their size, so a merging task holds at most ``MERGE_BYTES`` of them.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prelaunch.functions.scalars import quoted

MERGE_BYTES = 64 << 20
ROUNDING = 1e-13             # of the squares: what a column without variation may show of it
MOST_TASKS = 1 << 16         # merged within the tree's fan-in; more tasks make its last groups larger


class Moments:
    """Counts n, means m (of the row's column where the column's is present), co-moments c and second moments s, all k x k."""

    def __init__(self, n: np.ndarray, m: np.ndarray, c: np.ndarray, s: np.ndarray):
        self.n, self.m, self.c, self.s = n, m, c, s

    @staticmethod
    def of(x: np.ndarray, mark: np.ndarray) -> Moments:
        # products are taken about each column's median, so that constants leave exact zeros and outliers cost no digits
        with warnings.catch_warnings():
            warnings.simplefilter("ignore", RuntimeWarning)      # a column without values in this batch
            shift = np.nanmedian(np.where(mark, x, np.nan), axis=0)
        shift = np.where(np.isfinite(shift), shift, 0)
        off = np.where(mark, x - shift, 0)
        w = mark.astype(np.float64)
        n, total = w.T @ w, off.T @ w
        least = np.maximum(n, 1)
        squares = (off * off).T @ w
        s = squares - total * total / least
        return Moments(n, total / least + shift[:, None], off.T @ off - total * total.T / least, np.where((s > ROUNDING * squares) | np.isnan(s), s, 0))

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        least = np.maximum(n, 1)
        # the mean of an empty side does not count
        d = np.where((self.n > 0) & (other.n > 0), other.m - self.m, 0)
        both = self.n * other.n / least
        m = np.where(self.n == 0, other.m, np.where(other.n == 0, self.m, self.m + d * other.n / least))
        return Moments(n, m, self.c + other.c + d * d.T * both, self.s + other.s + d * d * both)

    def to_bytes(self) -> bytes:
        return np.stack([self.n, self.m, self.c, self.s]).tobytes()

    @staticmethod
    def from_bytes(raw: bytes, k: int) -> Moments:
        return Moments(*np.frombuffer(raw, np.float64).reshape(4, k, k))

    def correlations(self) -> np.ndarray:
        """NaN where a column has values that are not numbers, inf where a pair has no correlation."""
        with np.errstate(all="ignore"):
            scale = np.sqrt(self.s) * np.sqrt(self.s.T)
            r = np.where(np.eye(len(scale), dtype=bool), 1.0, np.clip(self.c / scale, -1, 1))
        return np.where(np.isnan(scale) | np.isnan(self.c), np.nan, np.where(scale > 0, r, np.inf))


def moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """(part, g): one row with the moments of ``cols`` as bytes; no row for an empty table."""
    k = len(cols)
    schema = "part int, g binary"

    def products(batches):
        held = None
        for batch in batches:
            mark = np.column_stack([batch.column(i).is_valid().to_numpy(zero_copy_only=False) for i in range(k)])
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(k)]).astype(np.float64)
            got = Moments.of(x, mark)
            held = got if held is None else held + got
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([held.to_bytes()], pa.binary())], ["part", "g"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        held = None
        for raw in table.column("g").to_pylist():
            got = Moments.from_bytes(raw, k)
            held = got if held is None else held + got
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "g": pa.array([held.to_bytes()], pa.binary())})

    fan_in = int(min(256, max(4, MERGE_BYTES // (32 * k * k))))
    rounds = math.ceil(math.log(MOST_TASKS, fan_in))
    parts = df.select(*[F.col(quoted(c)).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(products, schema)
    for i in range(rounds):
        up = F.lit(0) if i == rounds - 1 else F.floor(F.col("part") / fan_in)
        parts = parts.groupBy(up.cast("int").alias("w_part")).applyInArrow(merge, schema)
    return parts


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(var_a, var_b, corr) for every two of ``cols``, over the rows on which both are present; null where one of them does
    not vary there, or no row has both."""
    k, schema = len(cols), "var_a string, var_b string, corr double"
    if not k:
        return df.sparkSession.createDataFrame([], schema)

    def listed(batches):
        for batch in batches:
            for raw in batch.column("g").to_pylist():
                r = Moments.from_bytes(raw, k).correlations()
                values = pa.array([None if v == np.inf else float(v) for v in r.ravel()], pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([a for a in cols for _ in cols]), pa.array(cols * k), values], ["var_a", "var_b", "corr"])

    found = moments(df, cols).select("g").mapInArrow(listed, schema)
    # every pair is listed, also without rows
    spark = df.sparkSession
    names = spark.createDataFrame([(i, c) for i, c in enumerate(cols)], "i int, c string")
    pairs = names.select(F.col("c").alias("var_a")).crossJoin(names.select(F.col("c").alias("var_b")))
    return pairs.join(found, ["var_a", "var_b"], "left").select("var_a", "var_b", "corr")
