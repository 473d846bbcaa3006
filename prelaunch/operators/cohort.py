"""Cohort preparation and row filters (COH1-COH6, FIL1-FIL3, SPL1).

Filters are plain predicates so Catalyst pushes them into the Parquet
scan; the studio-size filter is an aggregate plus a semi join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prelaunch.functions import scalars as S
from prelaunch.functions.scalars import quoted
from prelaunch.plans.joins import BROADCAST_MAX_BYTES, estimated_bytes
from prelaunch.session import checkpoint_dir

# The reference cohort and split.
PRICE_RANGE = (0.0, 30.0)
MAX_STUDIO_GAMES = 3
FIRST_YEAR = 2020
SUCCESS_OWNERS = 20_000
TRAIN_YEARS = (2020, 2023)
TEST_FROM = 2024
# Tasks that a hot key is spread over when a join cannot be broadcast.
SALTS = 32

# Post-launch columns that must never be features.
POST_LAUNCH_COLUMNS = [
    "estimated_owners", "peak_ccu", "positive", "negative", "recommendations",
    "user_score", "score_rank", "metacritic_score", "metacritic_url", "reviews",
    "average_playtime_forever", "average_playtime_2weeks", "median_playtime_forever",
    "median_playtime_2weeks", "discount", "tags", "notes", "days_since_release",
]


def with_release_parts(df: DataFrame, date_col: str = "release_date",
                       formats: tuple[str, ...] = S.DATE_FORMATS) -> DataFrame:
    """Parse the release date and add year, month, quarter (SCA5, SCA6).

    Timestamp and date columns are used as they are; text is parsed by the
    first of ``formats`` that fits, invalid dates becoming null.
    """
    dtype = df.schema[date_col].dataType.simpleString()
    ts = F.col(date_col) if dtype in ("timestamp", "timestamp_ntz", "date") else S.parse_date(date_col, formats)
    return df.withColumn("release_ts", ts).withColumns(S.calendar_parts("release_ts"))


def price_filter(df: DataFrame, lo: float = PRICE_RANGE[0], hi: float = PRICE_RANGE[1],
                 col: str = "price") -> DataFrame:
    """Keep lo <= price <= hi (COH1)."""
    return df.where(F.col(col).between(lo, hi))


def developer_counts(df: DataFrame, key: str = "developers") -> DataFrame:
    """Rows per non-null key: one partially aggregated shuffle."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("dev_game_count")))


HOT_KEYS = 2_000             # a key is hot if it has more than one in so many of the rows, so there are at most so many


def hot_keys(counts: DataFrame, key: str, n: str) -> DataFrame:
    """The keys of a (key, n) table that hold more than a ``HOT_KEYS``-th of all rows; fewer than ``HOT_KEYS`` by that."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.where(F.col(n) * HOT_KEYS > total).select(key)


def with_developer_count(df: DataFrame, key: str = "developers",
                         counts: DataFrame | None = None, broadcast_bytes: int | None = None) -> DataFrame:
    """Each row's key count over the whole table, itself included (JOI1).

    Counted with a grouped aggregate (map-side combine, so a studio holding
    a third of all rows costs one partial row per task) and joined back on
    the key: broadcast when the checked count table is small, otherwise a
    shuffle join on (key, salt). The counts tell which keys are hot; only their rows are salted, and only their counts are
    repeated for every salt, so a hot key is spread over ``SALTS`` tasks and all others cost what a plain join costs. Rows with
    a null key get null and take no part in the join.
    """
    counts = counts if counts is not None else developer_counts(df, key)
    size = estimated_bytes(counts)
    if size is not None and size <= (BROADCAST_MAX_BYTES if broadcast_bytes is None else broadcast_bytes):
        return df.join(F.broadcast(counts), key, "left")
    checkpoint_dir(df.sparkSession)
    counts = counts.checkpoint()
    known, nulls = df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())
    hot = F.broadcast(hot_keys(counts, key, "dev_game_count").withColumn("__hot", F.lit(SALTS)))
    last = F.coalesce(F.col("__hot"), F.lit(1)) - 1
    salted = counts.join(hot, key, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), last))).drop("__hot")
    others = [c for c in df.columns if c != key]
    drawn = F.pmod(F.xxhash64(*[quoted(c) for c in others] or [key]), F.lit(SALTS)).cast("int")
    spread = known.join(hot, key, "left").withColumn("__salt", F.when(F.col("__hot").isNotNull(), drawn).otherwise(0)).drop("__hot")
    joined = spread.join(salted, [key, "__salt"], "left").drop("__salt")
    return joined.unionByName(nulls.withColumn("dev_game_count", F.lit(None).cast("long")))


def studio_size_filter(df: DataFrame, max_games: int = MAX_STUDIO_GAMES,
                       key: str = "developers") -> DataFrame:
    """Keep games of keys with at most ``max_games`` rows (COH2).

    A semi join against the small studios; rows with a null key have no
    known size and are dropped. Where that join shuffles, rows of hot keys, which cannot match, leave before it.
    """
    counts = developer_counts(df, key)
    small = counts.where(F.col("dev_game_count") <= max_games).select(key)
    size = estimated_bytes(small)
    if size is not None and size <= BROADCAST_MAX_BYTES:
        return df.join(F.broadcast(small), key, "left_semi")
    checkpoint_dir(df.sparkSession)
    counts = counts.checkpoint()
    hot = hot_keys(counts.where(F.col("dev_game_count") > max_games), key, "dev_game_count")
    small = counts.where(F.col("dev_game_count") <= max_games).select(key)
    return df.join(F.broadcast(hot), key, "left_anti").join(small, key, "left_semi")


def release_window_filter(df: DataFrame, first_year: int = FIRST_YEAR,
                          year: str = "release_year") -> DataFrame:
    """Keep release year >= first_year (COH3)."""
    return df.where(F.col(year) >= first_year)


def success_label(owners: Column | str = "estimated_owners", threshold: int = SUCCESS_OWNERS) -> Column:
    """``owners >= threshold`` as 0/1; null stays null (COH4)."""
    o = F.col(owners) if isinstance(owners, str) else owners
    return (o >= threshold).cast("int")


def cohort_funnel(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Rows left after each cumulative filter, in one pass (COH5).

    ``steps`` is an ordered list of (name, predicate); a null predicate
    counts as not kept, as a filter would.
    """
    aggs, conds = [F.count(F.lit(1)).alias("s0")], []
    for i, (_, pred) in enumerate(steps, start=1):
        conds.append(F.coalesce(pred, F.lit(False)))
        aggs.append(F.count_if(reduce(lambda a, b: a & b, conds)).alias(f"s{i}"))
    wide = df.agg(*aggs)
    names = ["all rows"] + [n for n, _ in steps]
    st = F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"),
                                      F.col(f"s{i}").alias("rows")) for i, n in enumerate(names)]))
    return wide.select(st.alias("s")).select("s.*")


def leakage_guard(columns: list[str], deny: list[str] = POST_LAUNCH_COLUMNS) -> list[str]:
    """Reject a feature list that names a post-launch column (COH6)."""
    bad = sorted(set(columns) & set(deny))
    if bad:
        raise ValueError(f"post-launch columns cannot be features: {bad}")
    return columns


def leakage_report(df: DataFrame, columns: list[str] | None = None, deny: list[str] = POST_LAUNCH_COLUMNS) -> DataFrame:
    """(column_name, post_launch, n_present) of the table's columns: what the guard rejects, and how many rows have it. One scan."""
    columns = columns or df.columns
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c in set(deny)).alias("post_launch"), F.col(f"n{i}").alias("n_present"))
                               for i, c in enumerate(columns)]))
    return wide.select(rows.alias("r")).select("r.*")


def target_not_null(df: DataFrame, target: str = "success") -> DataFrame:
    """Drop rows without a target (FIL1)."""
    return df.where(F.col(target).isNotNull())


def temporal_split(df: DataFrame, year: str = "release_year", train_years=TRAIN_YEARS,
                   test_from: int = TEST_FROM) -> DataFrame:
    """Add ``split`` in {train, test, none} by release year (SPL1, FIL2, FIL3).

    Years before the window and null years are in neither set.
    """
    y = F.col(year)
    return df.withColumn("split", F.when(y.between(*train_years), "train")
                         .when(y >= test_from, "test").otherwise("none"))


def train_rows(df: DataFrame, year: str = "release_year", train_years=TRAIN_YEARS) -> DataFrame:
    """Rows of the training window (FIL2)."""
    return df.where(F.col(year).between(*train_years))


def test_rows(df: DataFrame, year: str = "release_year", test_from: int = TEST_FROM) -> DataFrame:
    """Rows at or after the test start (FIL3)."""
    return df.where(F.col(year) >= test_from)
