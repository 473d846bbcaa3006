"""Table profiling (AGG1-AGG17, AGG20-AGG22, TOP1, TOP4, FIL4-FIL8, SNK6 data).

Every profile is one aggregate over the scan (several statistics share one
pass through conditional aggregates) followed by a reshape of its few-row
result. Group keys are small (class, year, bin, combination), so partial
aggregation leaves almost nothing to shuffle; hot keys cannot skew a task.
Distributions (moments, quartiles, whiskers) come from one table of counted
distinct values, which ``ranks`` orders range by range; pass ``accuracy`` for
a bounded sketch of the quantiles in the same scan instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prelaunch.functions import scalars as S
from prelaunch.operators import gram
from prelaunch.operators.dictionary import distinct_values
from prelaunch.operators.ranks import counted_values, quantiles_of
from prelaunch.plans.joins import broadcast_if_few
from prelaunch.session import checkpoint_dir

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC_TYPES)


def _missing(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _stacked(df: DataFrame, cols: list[str], name: str = "feature") -> DataFrame:
    """(name, value): one row per column and present numeric value; one scan."""
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias("value")) for c in cols]))
    return df.select(stack.alias("s")).select(f"s.{name}", "s.value").where(F.col("value").isNotNull())


def _distribution(long: DataFrame, keys: list[str], ps: dict[str, float], accuracy: int | None) -> tuple[DataFrame, DataFrame]:
    """(per group: count, mean, std (ddof 1), min, max and the quantiles ``ps``; the points (keys, value, __n) they came from).

    Exact: the distinct values are counted in one scan of ``long`` (keys, value), all numbers come from the counts. With
    ``accuracy`` the quantiles are bounded sketches, and all numbers come from one aggregate; the points are ``long`` itself.
    """
    v = F.col("value")
    if accuracy:
        found = long.groupBy(*keys).agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
                                        *[F.percentile_approx("value", p, accuracy).cast("double").alias(n) for n, p in ps.items()])
        return found, long.withColumn("__n", F.lit(1))
    points, n = counted_values(long, keys, "value"), F.col("__n")
    means = points.groupBy(*keys).agg(F.sum(n).alias("count"), (F.sum(n * v) / F.sum(n)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")).checkpoint()
    # squares about the mean: a second look at the counts, beside a few rows of means
    off = points.join(broadcast_if_few(means.select(*keys, "mean")), keys)
    squares = off.groupBy(*keys).agg(F.sum(n * (v - F.col("mean")) ** 2).alias("__squares"))
    moments = means.join(squares, keys).withColumn("std", F.when(F.col("count") > 1, F.sqrt(F.col("__squares") / (F.col("count") - 1)))).drop("__squares")
    return (moments.join(quantiles_of(points, keys, "value", ps), keys) if ps else moments), points


def dataset_size(df: DataFrame) -> DataFrame:
    """Rows and columns of the table (AGG1)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)))


def missing_values(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: null count and percent of rows, rounded to 2 (AGG2)."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("n_missing"))
        for i, c in enumerate(cols)]))
    return (wide.select("__n", stack.alias("s"))
            .select("s.column_name", "s.n_missing",
                    F.round(F.try_divide("s.n_missing", "__n") * 100, 2).alias("missing_pct")))


def significant_missing(df: DataFrame, threshold_pct: float = 5.0,
                        cols: list[str] | None = None) -> DataFrame:
    """Columns whose missing share exceeds the threshold (FIL6)."""
    return missing_values(df, cols).where(F.col("missing_pct") > threshold_pct)


def top_missing(df: DataFrame, k: int = 10, threshold_pct: float = 5.0,
                cols: list[str] | None = None) -> DataFrame:
    """The k most-missing significant columns, ranked (TOP1)."""
    sig = significant_missing(df, threshold_pct, cols)
    return _ranked(sig, [F.desc("missing_pct"), F.asc("column_name")], k)


def _ranked(df: DataFrame, order: list[Column], k: int | None) -> DataFrame:
    """Top-k by ``order`` with an explicit rank column.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each partition
    keeps only its k best rows; only k rows per partition reach one task.
    The rank is numbered on those k rows.
    """
    top = df.orderBy(*order).limit(k) if k else df
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def numeric_summary(df: DataFrame, cols: list[str], accuracy: int | None = None) -> DataFrame:
    """Mean, median, min and max of numeric variables (AGG3)."""
    cols = [c for c in cols if c in df.columns and _is_numeric(df, c)]
    found, _ = _distribution(_stacked(df, cols, "variable"), ["variable"], {"median": 0.5}, accuracy)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")     # columns without any value, too
    return names.join(found, "variable", "left").select("variable", "mean", "median", "min", "max")


def categorical_summary(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """Type name and distinct non-null count of non-numeric variables (AGG4).

    Exact counts fold pairs of (column, value) in the map and exchange only those, one shuffle for all columns of a type,
    whatever their number; ``approximate`` keeps a sketch per column instead.
    """
    cols = [c for c in cols if c in df.columns and not _is_numeric(df, c)]
    names = df.sparkSession.createDataFrame([(i, c, df.schema[c].dataType.simpleString()) for i, c in enumerate(cols)], "at int, variable string, dtype string")
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(F.col(c)).alias(f"d{i}") for i, c in enumerate(cols)])
        counts = wide.select(F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"d{i}").alias("n_distinct")) for i in range(len(cols))])).alias("s")).select("s.*")
    else:
        per_type = [v.where("value is not null").select("at") for v in distinct_values(df, cols).values()]
        counts = reduce(DataFrame.unionByName, per_type, df.sparkSession.createDataFrame([], "at int")).groupBy("at").agg(F.count(F.lit(1)).alias("n_distinct"))
    return names.join(counts, "at", "left").select("variable", "dtype", F.coalesce("n_distinct", F.lit(0)).cast("bigint").alias("n_distinct"))


def target_summary(df: DataFrame, target: str = "success", year: str = "year") -> DataFrame:
    """Success rate, successes, rows with a target, year range (AGG5)."""
    y = F.col(target).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(y).alias("success_rate"),
                  F.sum(F.col(target)).cast("bigint").alias("n_success"),
                  F.min(year).alias("min_year"), F.max(year).alias("max_year"))


def yearly_stats(df: DataFrame, target: str = "success", year: str = "year") -> DataFrame:
    """Per year: mean target and rows with a target; null years dropped (AGG6)."""
    return (df.where(F.col(year).isNotNull()).groupBy(year)
            .agg(F.avg(F.col(target).cast("double")).alias("success_rate"),
                 F.count(target).alias("total_games")))


def relative_change(yearly: DataFrame, rate: str = "success_rate", period: str = "year") -> DataFrame:
    """(last - first) / first * 100 over ordered periods; null with < 2 (AGG20)."""
    return yearly.agg(
        F.min(period).alias("first_period"), F.max(period).alias("last_period"),
        F.min_by(rate, period).alias("first_rate"), F.max_by(rate, period).alias("last_rate"),
        F.count(F.lit(1)).alias("n_periods"),
    ).withColumn("change_pct", F.when(
        F.col("n_periods") >= 2,
        F.try_divide(F.col("last_rate") - F.col("first_rate"), F.col("first_rate")) * 100))


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width histogram on [lo, hi]; last bin right-closed (AGG7).

    Values outside the range and nulls are dropped. Every bin is listed,
    empty ones with 0, by joining the ``bins``-row dimension.
    """
    width = (hi - lo) / bins
    x = F.col(col).cast("double")
    idx = F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("int")
    counts = (df.where((x >= lo) & (x <= hi)).select(idx.alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    dim = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (dim.join(F.broadcast(counts), "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * width).alias("bin_start"),
                    (F.lit(lo) + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


# Price band edges (right-closed) and their labels.
PRICE_EDGES = [-0.01, 5, 10, 15, 20, 30, 100]
PRICE_LABELS = ["$0-5", "$5-10", "$10-15", "$15-20", "$20-30", "$30+"]


def band(col: Column | str, edges: list[float] = PRICE_EDGES,
         labels: list[str] = PRICE_LABELS) -> Column:
    """Right-closed band label: (e0, e1] -> labels[0] ...; outside -> null."""
    x = F.col(col) if isinstance(col, str) else col
    expr = None
    for i, lab in enumerate(labels):
        cond = (x > edges[i]) & (x <= edges[i + 1])
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr


def binned_target_stats(df: DataFrame, col: str = "price", target: str = "success",
                        edges: list[float] = PRICE_EDGES, labels: list[str] = PRICE_LABELS) -> DataFrame:
    """Per band: mean target and target count; empty bands listed (AGG8)."""
    b = band(col, edges, labels)
    stats = (df.select(b.alias("band"), F.col(target).cast("double").alias("y"))
             .where(F.col("band").isNotNull()).groupBy("band")
             .agg(F.avg("y").alias("success_rate"), F.count("y").alias("count")))
    dim = df.sparkSession.createDataFrame([(i, lab) for i, lab in enumerate(labels)],
                                          "band_order int, band string")
    return (dim.join(F.broadcast(stats), "band", "left")
            .select(F.col("band").alias("price_range"), "band_order", "success_rate",
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def bands_with_min_count(binned: DataFrame, min_count: int = 100) -> DataFrame:
    """Bands holding at least ``min_count`` rows (FIL5)."""
    return binned.where(F.col("count") >= min_count)


def bin_coverage(df: DataFrame, col: str = "price", target: str = "success",
                 edges: list[float] = PRICE_EDGES, labels: list[str] = PRICE_LABELS) -> DataFrame:
    """Rows counted in the bands versus all rows (AGG9)."""
    b = band(col, edges, labels)
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count(F.when(b.isNotNull(), F.col(target))).alias("rows_in_bins")
                  ).withColumn("rows_lost", F.col("total_rows") - F.col("rows_in_bins"))


def price_extras(df: DataFrame, col: str = "price", cap: float = 50.0) -> DataFrame:
    """Mean of paid prices (FIL8) and count above the chart cap (FIL7)."""
    x = F.col(col)
    return df.agg(F.avg(F.when(x > 0, x)).alias("mean_paid_price"),
                  F.count_if(x > cap).alias("n_above_cap"))


def correlation_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations, long form (AGG10).

    One scan: every task multiplies the masked matrix of its rows with itself, and the k x k products are merged (see
    ``gram``), so neither the plan nor the number of scans grows with the columns. A pair in which one column is constant
    has no correlation (null).
    """
    return gram.correlations(df, [c for c in cols if c in df.columns])


def correlation_wide(df: DataFrame, cols: list[str]) -> DataFrame:
    """The same matrix, one row per variable and one column per variable."""
    long = correlation_long(df, cols)
    return long.groupBy("var_a").pivot("var_b", [c for c in cols if c in df.columns]).agg(F.first("corr"))


def _long_by_class(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """(cls, feature, value) for rows with a 0/1 target and a present value."""
    features = [f for f in features if f in df.columns]
    stack = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]))
    return (df.where(F.col(target).isin(0, 1))
            .select(F.col(target).cast("int").alias("cls"), stack.alias("s"))
            .select("cls", "s.feature", "s.value").where(F.col("value").isNotNull()))


_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
_MOMENTS = ["feature", "cls", "count", "mean", "std", "min", "q1", "median", "q3", "max"]


def class_moments(df: DataFrame, features: list[str], target: str = "success",
                  accuracy: int | None = None) -> DataFrame:
    """Per (feature, class): n, mean, std (ddof 1), min, q1, median, q3, max (FIL4).

    One scan for all features and both classes: the stacked long form is
    counted by (feature, class, value).
    """
    found, _ = _distribution(_long_by_class(df, features, target), ["feature", "cls"], _QUARTILES, accuracy)
    return found.select(*_MOMENTS)


def box_stats(df: DataFrame, features: list[str], target: str = "success",
              accuracy: int | None = None, whis: float = 1.5) -> DataFrame:
    """Box-plot numbers per (feature, class) (AGG11).

    Whiskers are the most extreme values within ``whis`` IQRs of the
    quartiles; outliers are the values beyond. They come from the counted
    values that the quartiles came from, beside a few rows of fences.
    """
    m, points = _distribution(_long_by_class(df, features, target), ["feature", "cls"], _QUARTILES, accuracy)
    checkpoint_dir(df.sparkSession)
    reach = whis * (F.col("q3") - F.col("q1"))
    # a row per feature and class
    m = m.withColumns({"lo": F.col("q1") - reach, "hi": F.col("q3") + reach}).checkpoint()
    fences = m.select("feature", "cls", "lo", "hi")
    v, outside = F.col("value"), (F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))
    w = points.join(broadcast_if_few(fences), ["feature", "cls"]).groupBy("feature", "cls").agg(
        F.min(F.when(v >= F.col("lo"), v)).alias("whisker_low"),
        F.max(F.when(v <= F.col("hi"), v)).alias("whisker_high"),
        F.sum(F.when(outside, F.col("__n")).otherwise(0)).cast("bigint").alias("n_outliers"))
    return m.select("feature", "cls", "q1", "median", "q3", "mean", "count").join(w, ["feature", "cls"])


_METRICS = ["count", "mean", "median", "std", "min", "q1", "q3", "max", "iqr"]


def class_comparison(df: DataFrame, features: list[str], target: str = "success",
                     accuracy: int | None = None) -> DataFrame:
    """Per feature and metric: unsuccessful, successful, difference (AGG12).

    Difference: count -> successful - unsuccessful; other metrics -> percent
    change over the unsuccessful value (SCA20).
    """
    m = class_moments(df, features, target, accuracy).withColumn("iqr", F.col("q3") - F.col("q1"))
    per = m.groupBy("feature").agg(*[
        F.first(F.when(F.col("cls") == c, F.col(k)), ignorenulls=True).cast("double").alias(f"{k}_{c}")
        for k in _METRICS for c in (0, 1)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(k).alias("metric"), F.col(f"{k}_0").alias("unsuccessful"),
                 F.col(f"{k}_1").alias("successful"),
                 S.pct_difference(F.col(f"{k}_0"), F.col(f"{k}_1"), is_count=(k == "count")).alias("difference"))
        for k in _METRICS]))
    return per.select("feature", rows.alias("r")).select("feature", "r.*")


def cohens_d(df: DataFrame, features: list[str], target: str = "success") -> DataFrame:
    """Pooled-std effect size of successful vs unsuccessful, with label (AGG13). Counts, means and deviations only: one aggregate."""
    v = F.col("value")
    m = _long_by_class(df, features, target).groupBy("feature", "cls").agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))
    per = m.groupBy("feature").agg(*[
        F.first(F.when(F.col("cls") == c, F.col(k)), ignorenulls=True).alias(f"{k}{c}")
        for k in ("count", "mean", "std") for c in (0, 1)])
    pooled = F.sqrt(((F.col("count0") - 1) * F.col("std0") ** 2 + (F.col("count1") - 1) * F.col("std1") ** 2)
                    / (F.col("count0") + F.col("count1") - 2))
    d = F.when(pooled > 0, (F.col("mean1") - F.col("mean0")) / pooled)
    return per.select("feature", pooled.alias("pooled_std"), d.alias("cohens_d")).withColumn(
        "effect", S.effect_label("cohens_d"))


def flag_totals(df: DataFrame, flags: list[str]) -> DataFrame:
    """Per flag: rows with the flag set and percent of all rows (AGG14)."""
    flags = [f for f in flags if f in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(f).cast("boolean")).alias(f"f{i}") for i, f in enumerate(flags)])
    st = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f"f{i}").alias("count"))
                             for i, f in enumerate(flags)]))
    return wide.select("__n", st.alias("s")).select(
        "s.flag", "s.count", (F.try_divide("s.count", "__n") * 100).alias("pct"))


def with_combo(df: DataFrame, flags: list[str], labels: dict[str, str] = S.PLATFORM_COMBOS) -> DataFrame:
    code = S.combo_code(flags)
    return df.withColumn("combo_code", code).withColumn("combo_label", S.lookup(code, labels))


def combo_distribution(df: DataFrame, flags: list[str], labels: dict[str, str] = S.PLATFORM_COMBOS) -> DataFrame:
    """Count and percent of all rows per combination label (AGG15, TOP4 order).

    Percent is over all rows; rows without a label are not listed. The
    ``order`` column gives the chart order: ascending count, then label.
    """
    c = with_combo(df, flags, labels)
    total = df.agg(F.count(F.lit(1))).scalar()
    g = (c.where(F.col("combo_label").isNotNull()).groupBy("combo_label")
         .agg(F.count(F.lit(1)).alias("count")))
    return g.select("combo_label", "count", (F.col("count") / total * 100).alias("pct")).withColumn(
        "order", F.row_number().over(Window.orderBy("count", "combo_label")))


def combo_success(df: DataFrame, flags: list[str], target: str = "success",
                  labels: dict[str, str] = S.PLATFORM_COMBOS) -> DataFrame:
    """Mean target per combination label (AGG16)."""
    c = with_combo(df, flags, labels)
    return (c.where(F.col("combo_label").isNotNull()).groupBy("combo_label")
            .agg(F.avg(F.col(target).cast("double")).alias("success_rate")))


def class_distribution(df: DataFrame, target: str = "success") -> DataFrame:
    """Rows per class, percent of rows with a target, imbalance n0/n1 (AGG17). One aggregate; shares over its few rows."""
    y = F.col(target)
    counts = df.where(y.isNotNull()).groupBy(y.cast("int").alias(target)).agg(F.count(F.lit(1)).alias("count"))
    everything = Window.partitionBy(F.lit(1))
    of = lambda c: F.sum(F.when(F.col(target) == c, F.col("count"))).over(everything)
    return counts.select(target, "count", (F.col("count") / F.sum("count").over(everything) * 100).alias("pct"),
                         F.try_divide(F.coalesce(of(0), F.lit(0)).cast("double"), of(1)).alias("imbalance_ratio"))


def majority_accuracy(df: DataFrame, target: str = "success") -> DataFrame:
    """Accuracy of always predicting the negative class (EVA10)."""
    return df.agg((1 - F.avg(F.col(target).cast("double"))).alias("majority_accuracy"))


def feature_means(df: DataFrame, cols: list[str], key: str | None = "developers") -> DataFrame:
    """Averages of derived features and distinct key count (AGG21)."""
    aggs = [F.avg(F.col(c).cast("double")).alias(f"avg_{c}") for c in cols if c in df.columns]
    if key and key in df.columns:
        aggs.append(F.count_distinct(key).alias(f"n_{key}"))
    return df.agg(*aggs)


def summary_stats(df: DataFrame, target: str = "success", year: str = "year",
                  missing_threshold: float = 5.0) -> DataFrame:
    """The six headline numbers of a profile, one row (SNK6 data)."""
    y, period = F.col(target), F.col(year)
    cols = df.columns
    # one scan: per period, then over the periods
    per = df.groupBy(period.alias("__p")).agg(
        F.count(F.lit(1)).alias("n"), F.count(y).alias("ny"), F.sum(y.cast("double")).alias("sy"), F.avg(y.cast("double")).alias("rate"),
        F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"), *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(cols)])
    known = F.col("__p").isNotNull()
    whole = per.agg(
        F.sum("n").alias("total_games"), F.try_divide(F.sum("sy"), F.sum("ny")).alias("success_rate"),
        F.concat_ws("-", F.min("__p").cast("string"), F.max("__p").cast("string")).alias("date_range"),
        F.try_divide(F.sum("n0").cast("double"), F.sum("n1")).alias("class_imbalance_ratio"),
        *[F.sum(f"m{i}").alias(f"m{i}") for i in range(len(cols))], F.count_if(known).alias("np"),
        F.min_by(F.when(known, F.col("rate")), F.col("__p")).alias("first"), F.max_by(F.when(known, F.col("rate")), F.col("__p")).alias("last"))
    share = lambda i: F.round(F.try_divide(f"m{i}", "total_games") * 100, 2) > missing_threshold
    over = sum((F.coalesce(share(i), F.lit(False)).cast("long") for i in range(len(cols))), F.lit(0).cast("long"))
    change = F.when(F.col("np") >= 2, F.try_divide(F.col("last") - F.col("first"), F.col("first")) * 100)
    return whole.select(F.coalesce("total_games", F.lit(0)).alias("total_games"), "success_rate", "date_range", "class_imbalance_ratio",
                        over.alias("features_with_missing_data"), change.alias("temporal_decline"))


def profile(df: DataFrame, target: str = "success", year: str = "year", numeric: list[str] | None = None,
            flags: list[str] | None = None, missing_threshold: float = 5.0) -> dict[str, DataFrame]:
    """All profile tables of one catalogue: the input is read, and its lineage cut, once.

    The columns that the tables need are checkpointed into the shared folder
    and every table is an aggregate over that copy.
    """
    checkpoint_dir(df.sparkSession)
    numeric = [c for c in (numeric if numeric is not None else df.columns) if c in df.columns and _is_numeric(df, c) and c not in (target, year)]
    flags = [c for c in flags or [] if c in df.columns]
    base = df.checkpoint()
    return {"size": dataset_size(base), "missing": missing_values(base), "significant_missing": significant_missing(base, missing_threshold),
            "numeric": numeric_summary(base, numeric), "target": target_summary(base, target, year),
            "yearly": yearly_stats(base, target, year), "classes": class_distribution(base, target),
            "comparison": class_comparison(base, numeric, target), "effects": cohens_d(base, numeric, target),
            **({"flags": flag_totals(base, flags)} if flags else {}), "summary": summary_stats(base, target, year, missing_threshold)}
