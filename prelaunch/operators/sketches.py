"""Profiles that merge: exact counts and moments beside HyperLogLog and KLL sketches (AGG2-AGG4, SNK6).

A profile is a table with a row per column: rows, nulls, mean, squares about the mean, extremes, a distinct-count sketch and a
quantile sketch. The profile of a new day or partition is made from that day alone and merged with the stored ones; nothing is
read again. Counts, nulls, extremes and moments of a merged profile are those of the whole; distinct counts are
within about 3 % (``LOG_BUCKETS`` 12) and quantile ranks within about 1.5 % (``KLL_K`` 256), however often profiles are merged.
All columns are profiled by one aggregate over one scan, with as many groups as columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prelaunch.functions.scalars import quoted
from prelaunch.operators.profile import _is_numeric, _missing

LOG_BUCKETS = 12
KLL_K = 256


def profile_sketch(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column_name, n, n_missing, mean, squares, min, max, distinct_sketch, quantile_sketch) of the table's columns. Moments,
    extremes and quantiles are those of numeric columns; a NaN counts as missing."""
    cols = cols or df.columns
    cells = [F.struct(F.lit(c).alias("column_name"), F.when(~_missing(df, quoted(c) if "." in c else c), F.col(quoted(c)).cast("string")).alias("text"),
                      (F.when(~_missing(df, c), F.col(quoted(c)).cast("double")) if _is_numeric(df, c) else F.lit(None).cast("double")).alias("v")) for c in cols]
    long = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    return long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("text").isNull()).alias("n_missing"), F.avg("v").alias("mean"),
        (F.var_pop("v") * F.count("v")).alias("squares"), F.min("v").alias("min"), F.max("v").alias("max"), F.count("v").alias("n_numbers"),
        F.hll_sketch_agg("text", LOG_BUCKETS).alias("distinct_sketch"), F.kll_sketch_agg_double("v", KLL_K).alias("quantile_sketch"))


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """One profile of the rows of all, as if they had been read together. Columns that one of them lacks count for the others."""
    rows = reduce(DataFrame.unionByName, profiles)
    column = Window.partitionBy("column_name")           # a row per column and stored profile
    n, mean = F.col("n_numbers"), F.col("mean")
    rows = rows.withColumn("whole", F.sum(n * mean).over(column) / F.nullif(F.sum(n).over(column), F.lit(0)))
    return rows.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"), F.first("whole", ignorenulls=True).alias("mean"),
        F.sum(F.col("squares") + n * (mean - F.col("whole")) ** 2).alias("squares"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum(n).alias("n_numbers"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def summarise(profile: DataFrame, quantiles: dict[str, float] | None = None) -> DataFrame:
    """Readable numbers of a profile: rows, missing rows and percent, mean, std (ddof 1), extremes, distinct values, quantiles."""
    quantiles = quantiles if quantiles is not None else {"median": 0.5}
    some, n = F.col("n_numbers") > 0, F.col("n_numbers")
    return profile.select(
        "column_name", "n", "n_missing", F.round(F.try_divide(F.col("n_missing"), F.col("n")) * 100, 2).alias("missing_pct"), "mean",
        F.when(n > 1, F.sqrt(F.col("squares") / (n - 1))).alias("std"), "min", "max",
        F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
        *[F.when(some, F.kll_sketch_get_quantile_double(F.when(some, F.col("quantile_sketch")), F.lit(p))).alias(name) for name, p in quantiles.items()])
