"""Stand-in views over the driver's test tables (FIXTURES.md §3).

``games``  (G)  one row per order, shaped like the prepared catalogue.
``texts``  (D)  documents as short/detailed descriptions.
``labelled_texts`` (DL) documents with a 0/1 target from ``labels``.
``scored`` (S)  G rows with two deterministic score columns per model.
``constant_scored`` (T) S with one constant score (the train-mean baseline).

Every view is a lazy plan over the full tables; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.functions.scalars import hash_uniform
from prelaunch.plans.joins import broadcast_if_small
from prelaunch.sources.tables import read_table

# Fixed values of the fixture: success threshold on summed quantity, and the
# year windows that mirror the reference's 2020-2023 / 2024+ split on the
# 1995-2001 order dates.
SUCCESS_THRESHOLD = 150
TRAIN_YEARS = (1995, 1998)
TEST_FROM = 1999
MODEL_SEEDS = {"m42": "42", "m7": "7"}


def _list_text(c) -> F.Column:
    """Sorted distinct values as Python list text, e.g. ``['A', 'B']``."""
    quoted = F.transform(F.array_sort(F.collect_set(c)),
                         lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line aggregates: the only large shuffle of ``games``.

    Part and supplier->region are joined to the lines (broadcast when their
    checked size allows, else shuffle joins) and everything is reduced per
    order with partial (map-side) aggregation; the sets are bounded by the
    dimension cardinalities, so a hot order key cannot grow a group's state.
    """
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type", "p_brand"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    supp = (supplier
            .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", "r_name"))
    lines = (li.join(broadcast_if_small(part), F.col("l_partkey") == F.col("p_partkey"), "left")
               .join(broadcast_if_small(supp, size_of=supplier), F.col("l_suppkey") == F.col("s_suppkey"), "left"))
    return lines.groupBy("l_orderkey").agg(
        F.sum("l_quantity").cast("bigint").alias("estimated_owners"),
        F.count(F.lit(1)).alias("achievements"),
        F.size(F.collect_set("l_suppkey")).cast("bigint").alias("dlc_count"),
        F.bool_or(F.col("l_returnflag") == "A").alias("windows"),
        F.bool_or(F.col("l_returnflag") == "R").alias("mac"),
        F.bool_or(F.col("l_returnflag") == "N").alias("linux"),
        _list_text("p_type").alias("genres"),
        _list_text("p_brand").alias("categories"),
        _list_text("r_name").alias("supported_languages"),
    )


def games(spark: SparkSession, sf_dir: str, threshold: int = SUCCESS_THRESHOLD) -> DataFrame:
    """View G: one game per order, with injected nulls and bad dates."""
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    per = order_lines(spark, sf_dir)
    k = F.col("o_orderkey")
    g = o.join(per, k == F.col("l_orderkey"), "left")
    return g.select(
        k.alias("game_id"),
        F.when(k % 97 == 0, F.lit("not a date"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("release_date"),
        F.when(k % 10 == 0, F.lit(0.0)).when(k % 53 == 0, F.lit(None).cast("double"))
         .otherwise(F.floor(F.col("o_totalprice") / 100) / 100.0).alias("price"),
        "estimated_owners",
        (F.col("estimated_owners") >= threshold).cast("int").alias("success"),
        "achievements", "dlc_count", "windows", "mac", "linux",
        F.when(F.col("o_orderpriority") == "1-URGENT", 18).otherwise(0).alias("required_age"),
        F.when(F.col("o_custkey") % 41 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("developers"),
        "genres", "categories", "supported_languages",
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View D: every document as a description pair."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"])
    return d.select(
        "doc_id", F.col("text").alias("short_description"),
        F.when(F.col("doc_id") % 3 == 0, F.col("text")).alias("detailed_features"),
        "lang", "source")


def labelled_texts(spark: SparkSession, sf_dir: str, target: str = "quality") -> DataFrame:
    """View DL: D joined to labels; ``success`` is the chosen 0/1 target."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id", target])
    return texts(spark, sf_dir).join(lab, "doc_id").withColumn(
        "success", F.col(target).cast("int")).drop(target)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View S: (model, game_id, y, proba, pred) for two seeded models."""
    g = games(spark, sf_dir).where(F.col("success").isNotNull()).select("game_id", "success")
    # one pass over the games: every row becomes one row per model
    models = F.array(*[F.struct(F.lit(name).alias("model"), F.round(0.3 * F.col("success") + 0.7 * hash_uniform("game_id", seed), 3).alias("proba"))
                       for name, seed in MODEL_SEEDS.items()])
    one = g.select("game_id", F.col("success").alias("y"), F.explode(models).alias("m"))
    return one.select("m.model", "game_id", "y", "m.proba").withColumn("pred", (F.col("proba") >= 0.5).cast("int"))


def constant_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View T: the baseline rows, one constant score = mean target (JOI4)."""
    g = games(spark, sf_dir).where(F.col("success").isNotNull()).select("game_id", "success")
    # Scalar subquery: evaluated once, attached as a literal (no row pairing).
    p = g.agg(F.avg("success")).scalar()
    return g.select(F.lit("baseline").alias("model"), "game_id", F.col("success").alias("y"),
                    p.alias("proba"),
                    (hash_uniform("game_id", "42") < p).cast("int").alias("pred"))
