"""Shares of a task stay bounded, the games are read once, failed dates are not tried nine times."""

from pyspark.sql import functions as F

from conftest import SMALL

from prelaunch.functions import scalars as S
from prelaunch.plans import fixtures as FX
from prelaunch.plans import pipeline as PL


def test_a_fit_task_has_a_bounded_share(spark):
    one = spark.range(10_000).coalesce(1)
    got = PL.dealt(one, rows_per_task=500)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) == 20 and max(sizes) <= 600
    assert PL.dealt(one.limit(0)).count() == 0


def test_scored_reads_the_games_once(spark):
    scored = FX.scored(spark, SMALL)
    assert "Union" not in scored._jdf.queryExecution().optimizedPlan().toString()
    g = FX.games(spark, SMALL).where("success is not null")
    for name, seed in FX.MODEL_SEEDS.items():
        proba = F.round(0.3 * F.col("success") + 0.7 * S.hash_uniform("game_id", seed), 3)
        want = g.select("game_id", proba.alias("proba"), (proba >= 0.5).cast("int").alias("pred"))
        got = scored.where(F.col("model") == name).select("game_id", "proba", "pred")
        assert want.count() == got.count() and want.exceptAll(got).count() == 0


def test_dates_equal_every_format_tried_in_order(spark):
    texts = ["2024-02-03", "2024-02-30", "2024-13-01", "0000-01-01", "9999-12-31", "1582-10-10", " 2024-02-03", "2024-02-03 ", "2024-02-03\n", "2024-2-3",
             "2024-02-03 04:05:06", "2024-02-03T04:05:06", "2024/02/03", "Feb 3, 2024", "3 Feb, 2024", "February 3, 2024", "02/03/2024", "Feb 2024", "not a date",
             "Feb", "", "+2024-02-03", "٢٠٢٤-٠٢-٠٣", "20240-02-03", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    tried = F.coalesce(*[F.try_to_timestamp("v", F.lit(f)) for f in S.DATE_FORMATS])
    rows = df.select("v", tried.cast("string").alias("a"), S.parse_date("v").cast("string").alias("b")).collect()
    assert all(r.a == r.b for r in rows), [r for r in rows if r.a != r.b]
    assert "RLIKE" in df.select(S.parse_date("v"))._jdf.queryExecution().analyzed().toString()
