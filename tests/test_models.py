"""Property checks for the non-SQL operators (P rows of SURVEY §2)."""

import os
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL

import __spark_entry__ as E
from prelaunch.operators import encode as EN
from prelaunch.operators import evaluate as EV
from prelaunch.operators import models as MO
from prelaunch.plans import fixtures as FX
from prelaunch.plans import pipeline as PL
from prelaunch.plans.features import FeatureSpec, build_features
from prelaunch.sources import sinks


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["model", "precision", "recall", "f1", "pr_auc", "roc_auc"]
    assert {r.model for r in rows} == set(PL.MODEL_NAMES)


def test_cumulative_matches_single_window(spark):
    s = FX.scored(spark, MEDIUM)
    for ranges in (1, 3, 32):
        got = {(r.model, r.proba): (r.cum_pos, r.cum_neg) for r in EV.cumulative_by_score(s, ranges=ranges).collect()}
        pts = s.groupBy("model", "proba").agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("n"))
        w = Window.partitionBy("model").orderBy(F.desc("proba"))
        ref = {(r.model, r.proba): (r.cp, r.cn) for r in
               pts.select("model", "proba", F.sum("p").over(w).alias("cp"), F.sum("n").over(w).alias("cn")).collect()}
        assert got == ref


def test_stratified_split_is_partitioning_independent(spark):
    g = FX.games(spark, SMALL).where(F.col("success").isNotNull())
    a = {r.game_id: r.split for r in EN.stratified_split(g, "success", "game_id", n_buckets=8).collect()}
    b = {r.game_id: r.split for r in EN.stratified_split(g.repartition(3), "success", "game_id", n_buckets=64).collect()}
    assert a == b
    shares = g.join(spark.createDataFrame(list(a.items()), "game_id long, split string"), "game_id") \
              .groupBy("success").agg(F.avg((F.col("split") == "test").cast("double")).alias("t")).collect()
    assert all(abs(r.t - 0.3) < 0.01 for r in shares)


def test_pipeline_save_load_equal_predictions(spark):
    f, spec = build_features(FX.games(spark, SMALL), key="game_id")
    r = PL.train_and_evaluate(f, spec, "game_id", FX.TRAIN_YEARS, FX.TEST_FROM,
                              models=("random_forest",), forest_trees=10, forest_depth=5)
    assert r.model is not None and r.importances.count() == 15
    path = os.path.join(tempfile.mkdtemp(prefix="prelaunch-model-"), "m")
    sinks.save_model(r.model, path)
    data = f.where(F.col("release_year") >= FX.TEST_FROM).where(F.col("success").isNotNull()) \
            .select("game_id", *spec.numerical_features, *spec.categorical_features)
    a = r.model.transform(data).select("game_id", "probability").collect()
    b = MO.score_new_rows(path, data).select("game_id", "probability").collect()
    assert {x.game_id: x.probability for x in a} == {x.game_id: x.probability for x in b}


def test_feature_spec_roundtrip(spark):
    spec = FeatureSpec(["a", "b"], ["c"])
    path = os.path.join(tempfile.mkdtemp(prefix="prelaunch-spec-"), "spec")
    spec.write(spark, path)
    assert FeatureSpec.read(spark, path) == spec


def test_leakage_guard():
    from prelaunch.operators.cohort import leakage_guard
    with pytest.raises(ValueError):
        leakage_guard(["price", "estimated_owners"])


def test_csv_scan(spark):
    g = FX.games(spark, SMALL).limit(50)
    path = os.path.join(tempfile.mkdtemp(prefix="prelaunch-csv-"), "g")
    g.write.option("header", True).csv(path)
    from prelaunch.sources.games import read_games
    back = read_games(spark, path)
    assert back.schema["price"].dataType.simpleString() == "double"
    assert back.count() == 50


def test_depth_above_the_engine_is_an_error():
    with pytest.raises(ValueError):
        MO.forest(max_depth=31)


def test_split_falls_back_to_stratified(spark):
    g = FX.games(spark, SMALL).where(F.col("success").isNotNull())
    split = PL.with_split(g, FeatureSpec(), "game_id")
    share = split.groupBy("success").agg(F.avg((F.col("split") == "test").cast("double")).alias("t")).collect()
    assert all(abs(r.t - 0.3) < 0.01 for r in share)


def test_tags_as_vectors_reach_the_model(spark):
    f, spec = build_features(FX.games(spark, SMALL), key="game_id", tag_output="vector")
    assert set(spec.vector_features) == {"genre_tags", "category_tags"}
    r = PL.train_and_evaluate(f, spec, "game_id", FX.TRAIN_YEARS, FX.TEST_FROM, models=("random_forest",), forest_trees=5, forest_depth=4)
    assert r.importances.where("feature like 'category_%'").count() + r.importances.count() > 15
