"""Running totals in value order and exact quantiles, without a global sort (WIN1, AGG3, FIL4, AGG11).

A bare ``Window.orderBy`` pulls a whole group into one task. Here a group's distinct values are cut into ranges until no range
holds more than ``BOUND`` of them: every range that is still larger is cut by its own approximate quantiles, so how deep the
cutting goes is decided by the data, per range, not by a number of levels. A group that fits the bound is not cut at all. Running
sums are taken inside the ranges, and the sums of the ranges before give each range its offset.

Callers checkpoint the counted values into the shared folder, so the input is read once; a level of cutting is one aggregate
over them, and one join with the edges, which is a broadcast only while the counted edges are few. The driver sees two numbers
a level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prelaunch.plans.joins import broadcast_if_few
from prelaunch.session import checkpoint_dir

RANGES = 64                  # parts that a range above the bound is cut into
BOUND = 1 << 18              # distinct values that one window task may hold
EDGE_BYTES = 32 << 20        # edges up to this size are broadcast


def value_ranges(points: DataFrame, keys: list[str], value: str, bound: int = BOUND, ranges: int = RANGES) -> DataFrame:
    """``points`` (one row per keys and distinct non-null ``value``, a table that is cheap to read several times) with
    ``__range``, a number that grows with the value inside its group. A range holds at most ``bound`` rows; more only if its values are one number in double precision."""
    checkpoint_dir(points.sparkSession)
    ranges = max(ranges, 2)
    probs = [i / ranges for i in range(1, ranges)]
    cut, number = points.withColumn("__range", F.lit(0).cast("long")), F.col(value).cast("double")
    largest = _largest(cut, keys)
    while largest > bound:
        edges = (cut.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__size"), F.percentile_approx(number, probs, 4096).alias("__edges"))
                 .where(F.col("__size") > bound).drop("__size").checkpoint())
        inside = F.coalesce(F.size(F.filter("__edges", lambda e: e < number)), F.lit(0))
        cut = (_joined(cut, broadcast_if_few(edges, 8 * ranges + 64, EDGE_BYTES), [*keys, "__range"], "left")
               .withColumn("__range", F.col("__range") * ranges + inside).drop("__edges").checkpoint())
        before, largest = largest, _largest(cut, keys)
        if largest == before:
            break                # equal as doubles: nothing left to cut by
    return cut


def _largest(cut: DataFrame, keys: list[str]) -> int:
    """Rows of the largest range."""
    return cut.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__size")).agg(F.max("__size")).first()[0] or 0


def running_totals(points: DataFrame, keys: list[str], value: str, sums: dict[str, str], descending: bool = False,
                   ranges: int = RANGES, bound: int = BOUND, following: dict[str, str] | None = None) -> DataFrame:
    """``points`` (one row per keys and distinct non-null ``value``) with, for each ``column: name`` of ``sums``, the
    column's sum over all values of the group up to this one, and ``name + "_all"``, the group's total.

    ``following`` adds, for each ``column: name``, the column's value at the next point of the group (null at the last one),
    across the borders of ranges.
    """
    following = following or {}
    cut = value_ranges(points, keys, value, bound, ranges)
    order = F.desc(value) if descending else F.asc(value)
    inside = Window.partitionBy(*keys, "__range").orderBy(order)
    local = inside.rowsBetween(Window.unboundedPreceding, 0)
    local_sums = cut.withColumns({**{f"__l_{n}": F.sum(c).over(local) for c, n in sums.items()},
                                  **{f"__f_{n}": F.lead(c).over(inside) for c, n in following.items()},
                                  **({"__more": F.lead(F.lit(True), 1, False).over(inside)} if following else {})})
    range_order = F.desc("__range") if descending else F.asc("__range")
    over_ranges = Window.partitionBy(*keys).orderBy(range_order)
    before = over_ranges.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    first = F.max_by if descending else F.min_by
    per_range = cut.groupBy(*keys, "__range").agg(*[F.sum(c).alias(f"__r_{n}") for c, n in sums.items()],
                                                  *[first(c, value).alias(f"__g_{n}") for c, n in following.items()])
    offsets = per_range.select(*keys, "__range", *[F.coalesce(F.sum(f"__r_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in sums.values()],
                               *[F.sum(f"__r_{n}").over(whole).alias(f"{n}_all") for n in sums.values()],
                               *[F.lead(f"__g_{n}").over(over_ranges).alias(f"__h_{n}") for n in following.values()])
    joined = _joined(local_sums, offsets, [*keys, "__range"])
    return joined.withColumns({**{n: F.col(f"__o_{n}") + F.col(f"__l_{n}") for n in sums.values()},
                               **{n: F.when(F.col("__more"), F.col(f"__f_{n}")).otherwise(F.col(f"__h_{n}")) for n in following.values()}}).drop(
        "__range", "__more", *[f"__{k}_{n}" for k in "lo" for n in sums.values()], *[f"__{k}_{n}" for k in "fh" for n in following.values()])


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null."""
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    renamed = right.withColumnsRenamed(names)
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    return left.join(renamed, on, how).drop(*names.values())


def counted_values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, __n): rows per distinct non-null value, checkpointed. A hot group or a frequent value is one row a task and
    value before the shuffle."""
    checkpoint_dir(df.sparkSession)
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")).checkpoint()


def quantiles_of(points: DataFrame, keys: list[str], value: str, ps: dict[str, float], ranges: int = RANGES, bound: int = BOUND) -> DataFrame:
    """Per group: linearly interpolated quantiles (``name: p``) of counted values (see :func:`counted_values`)."""
    cum = running_totals(points, keys, value, {"__n": "__c"}, ranges=ranges, bound=bound)

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("__c") > rank, F.col(value)))

    last = F.col("__c_all") - 1
    picks = []
    for i, p in enumerate(ps.values()):
        pos = last * F.lit(p)
        picks += [at(F.floor(pos)).alias(f"__a{i}"), at(F.ceil(pos)).alias(f"__b{i}"), F.first(pos - F.floor(pos)).alias(f"__f{i}")]
    got = cum.groupBy(*keys).agg(*picks)
    return got.select(*keys, *[(F.col(f"__a{i}") * (1 - F.col(f"__f{i}")) + F.col(f"__b{i}") * F.col(f"__f{i}")).alias(name)
                               for i, name in enumerate(ps)])


def exact_quantiles(df: DataFrame, keys: list[str], value: str, ps: dict[str, float], ranges: int = RANGES, bound: int = BOUND) -> DataFrame:
    """Per group: linearly interpolated quantiles (``name: p``) of the non-null values."""
    return quantiles_of(counted_values(df, keys, value), keys, value, ps, ranges, bound)
