"""Refinement by data, exact cuts, masked Gram matrices, dictionaries, merged profiles, estimators of any kind."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from conftest import SMALL

from prelaunch.operators import cohort as C
from prelaunch.operators import dictionary as D
from prelaunch.operators import encode as EN
from prelaunch.operators import evaluate as EV
from prelaunch.operators import models as MO
from prelaunch.operators import profile as P
from prelaunch.operators import ranks as RK
from prelaunch.operators import sketches as SK
from prelaunch.plans import fixtures as FX
from prelaunch.plans import pipeline as PL
from prelaunch.plans.features import FeatureSpec, build_features


def heavy_points(spark):
    """A group with nearly all its values in a sliver, one with few values, one with a null key."""
    v = F.when(F.col("id") % 10 == 0, F.col("id").cast("double")).otherwise(F.lit(5.0) + F.col("id") * 1e-9)
    big = spark.range(30_000).select(F.lit("a").alias("k"), v.alias("v"), F.lit(1).alias("n"))
    return big.unionByName(spark.createDataFrame([("b", 1.0, 2), ("b", -3.0, 5), (None, 0.0, 7)], "k string, v double, n int"))


def test_ranges_hold_the_bound(spark):
    pts = heavy_points(spark).checkpoint()
    cut = RK.value_ranges(pts, ["k"], "v", bound=500, ranges=8).toPandas()
    assert cut.groupby(["k", "__range"], dropna=False).size().max() <= 500
    a = cut[cut.k == "a"].sort_values("v")
    assert a["__range"].is_monotonic_increasing and len(cut) == 30_003
    # a group within the bound is not cut
    assert (cut[cut.k != "a"]["__range"] == cut[cut.k != "a"]["__range"].min()).all()
    for descending in (False, True):
        got = RK.running_totals(pts, ["k"], "v", {"n": "c"}, descending, ranges=8, bound=500, following={"v": "next"}).toPandas()
        for k, g in [("a", got[got.k == "a"]), ("b", got[got.k == "b"]), (None, got[got.k.isna()])]:
            g = g.sort_values("v", ascending=not descending)
            assert g.c.tolist() == g.n.cumsum().tolist() and set(g.c_all) == {g.n.sum()}
            assert g.next.tolist()[:-1] == g.v.tolist()[1:] and np.isnan(g.next.tolist()[-1])


def test_values_equal_as_doubles_end_the_cutting(spark):
    pts = spark.range(100).select(F.lit(1).alias("k"), (F.col("id") + (1 << 60)).alias("v"), F.lit(1).alias("n")).checkpoint()
    got = RK.running_totals(pts, ["k"], "v", {"n": "c"}, bound=10).toPandas().sort_values("v")
    assert got.c.tolist() == list(range(1, 101))


def test_quantiles_of_many_values(spark):
    df = spark.range(20_000).select(F.lit(0).alias("k"), F.exp(F.col("id") / 1000).alias("v"))
    got = RK.exact_quantiles(df, ["k"], "v", {"q": 0.1, "m": 0.5}, bound=300).first()
    v = np.exp(np.arange(20_000) / 1000)
    assert np.allclose([got.q, got.m], np.quantile(v, [0.1, 0.5]))


@pytest.mark.parametrize("buckets,edge", [(4, 1), (4, 40), (4096, 10), (64, 100_000)])
def test_split_is_the_same_however_it_is_cut(spark, buckets, edge):
    df = spark.range(3_000).select("id", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 3).alias("y"))
    got = {r.id: r.split for r in EN.stratified_split(df, "y", "id", n_buckets=buckets, edge_rows=edge).collect()}
    rows = df.select("id", "y", EN.hash_uniform("id", "42").alias("u")).collect()
    want = {}
    for y in {r.y for r in rows}:
        mine = sorted((r.u, r.id) for r in rows if r.y == y)
        k = int(np.floor(0.3 * len(mine) + 0.5))
        want.update({i: "test" if n < k else "train" for n, (_, i) in enumerate(mine)})
    assert got == want


def test_split_of_repeated_keys_and_of_nothing(spark):
    df = spark.range(500).select(F.lit(7).alias("id"), F.lit(1).alias("y"))
    assert EN.stratified_split(df, "y", "id", n_buckets=16, edge_rows=10).where("split = 'test'").count() == 150
    assert EN.stratified_split(df.limit(0), "y", "id").count() == 0
    with pytest.raises(ValueError):
        EN.stratified_split(df, "y", "id", n_buckets=100)


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(4)
    n, k = 3_000, 60
    x = rng.normal(size=(n, k)) @ rng.normal(size=(k, k)) + 1e7
    x[:, 3] = 5.0
    x[:, 4] = x[:, 5] * -2
    gone = rng.random((n, k)) < 0.2
    cols = [f"c.{i}" for i in range(k)]
    rows = [tuple(None if g else float(v) for v, g in zip(a, b)) for a, b in zip(x, gone)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in cols)).repartition(13)
    got = {(r.var_a, r.var_b): r["corr"] for r in P.correlation_long(df, cols).collect()}
    assert len(got) == k * k
    for i, j in [(0, 1), (4, 5), (7, 7), (20, 59), (59, 20)]:
        both = ~gone[:, i] & ~gone[:, j]
        assert got[cols[i], cols[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert got[cols[3], cols[0]] is None and got[cols[3], cols[3]] is None
    assert len(df.transform(lambda d: P.correlation_long(d, cols))._jdf.queryExecution().analyzed().toString()) < 40_000


def test_correlations_edge_cases(spark):
    df = spark.createDataFrame([(1.0, None, 2.0, float("nan")), (2.0, None, 2.0, 1.0), (None, 3.0, 4.0, 2.0)], "a double, b double, c double, d double")
    got = {(r.var_a, r.var_b): r["corr"] for r in P.correlation_long(df, ["a", "b", "c", "d"]).collect()}
    assert got["a", "b"] is None and got["a", "c"] is None and got["a", "a"] == 1.0 and got["c", "c"] == 1.0 and np.isnan(got["a", "d"])
    empty = P.correlation_long(df.limit(0), ["a", "c"]).collect()
    assert len(empty) == 4 and all(r["corr"] is None for r in empty)


def test_dictionary_keeps_values_apart(spark):
    schema = "i int, d double, m decimal(12,4), t date, s string"
    day = dt.date(2020, 1, 1)
    rows = [(1, 1e7, Decimal("1.5000"), day, "a b"), (2, 1e-4, Decimal("-2"), None, "a_b"), (3, None, None, day, ""), (4, 2.5, Decimal("10"), dt.date(1900, 1, 1), None),
            (5, float("nan"), Decimal("0"), day, "it's \\"), (6, -0.0, Decimal("0"), day, "a b"), (7, 0.0, Decimal("0"), day, "a b")]
    df = spark.createDataFrame(rows, schema)
    for output, inline in (("vector", 256), ("vector", 0), ("columns", 256)):
        oh = EN.fit_one_hot(df, ["d", "m", "t", "s"], output=output, inline=inline)
        out = oh.stage.transform(df).collect()
        if output == "vector":
            slots = [[tuple(r[c].indices.tolist()) for c in oh.outputs] for r in out]
        else:
            slots = [[tuple(j for j, c in enumerate([o for o in oh.outputs if o.startswith(f"cat__{p}_")]) if r[c]) for p in "dmts"] for r in out]
        by = {r.i: s for r, s in zip(out, slots)}
        # sorted, the first dropped, NaN last of the numbers, null last of all; 0.0 and -0.0 are one value
        assert [by[i][0] for i in range(1, 8)] == [(2,), (0,), (4,), (1,), (3,), (), ()]
        assert [by[i][1] for i in range(1, 8)] == [(1,), (), (3,), (2,), (0,), (0,), (0,)]
        assert [by[i][2] for i in range(1, 5)] == [(0,), (1,), (0,), ()]
        assert [by[i][3] for i in range(1, 6)] == [(0,), (1,), (), (3,), (2,)]
        assert len(oh.names) == 5 + 4 + 2 + 4
        unseen = oh.stage.transform(spark.createDataFrame([(9, 3.0, Decimal("7"), None, "new")], schema)).first()
        assert output == "columns" or [unseen[c].numNonzeros() for c in oh.outputs] == [0, 0, 1, 0]


def test_dictionary_of_a_million_values_stays_a_table(spark):
    big = spark.range(0, 1_000_000, 1, 8).select(F.concat(F.lit("tag "), F.lpad(F.col("id").cast("string"), 7, "0")).alias("s"))
    e = D.fit_value_encoder(big, "s", "v", drop_first=False)
    assert e.getOrDefault("size") == 1_000_000
    few = spark.createDataFrame([("tag 0000000",), ("tag 0999999",), ("tag 0500000",), ("none",), (None,)], "s string")
    got = {r.s: r.v.indices.tolist() for r in e.transform(few).collect()}
    assert got == {"tag 0000000": [0], "tag 0999999": [999_999], "tag 0500000": [500_000], "none": [], None: []}
    assert e.names("s_").where("slot = 7").first().name == "s_tag_0000007"


def test_list_dictionary_and_its_saved_pipeline(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["c", None, "zz"]), (5, ["b", "a", "b"])], "i int, t array<string>")
    e = D.fit_list_encoder(df.where("i <> 4"), "t", "v")
    model = PipelineModel(stages=[e, EN.VectorSizeHint(inputCol="v", size=e.width, handleInvalid="optimistic"),
                                  VectorAssembler(inputCols=["v"], outputCol="f", handleInvalid="keep")])
    path = os.path.join(tempfile.mkdtemp(prefix="prelaunch-dict-"), "m")
    model.write().overwrite().save(path)
    for m in (model, PipelineModel.load(path)):
        assert {r.i: r.f.toArray().tolist() for r in m.transform(df).collect()} == {1: [1, 1], 2: [0, 0], 3: [0, 0], 4: [0, 0], 5: [1, 1]}


def test_wide_tag_tables_reach_the_model(spark, monkeypatch):
    from prelaunch.operators import tags as TG
    monkeypatch.setattr(TG, "INLINE", 2)
    f, spec = build_features(FX.games(spark, SMALL), key="game_id", tag_output="vector")
    assert spec.vector_features == {"genre_tags": [], "category_tags": []} and set(spec.name_tables) == {"genre_tags", "category_tags"}
    path = os.path.join(tempfile.mkdtemp(prefix="prelaunch-spec-"), "spec")
    spec.write(spark, path)
    back = FeatureSpec.read(spark, path)
    r = PL.train_and_evaluate(f, back, "game_id", FX.TRAIN_YEARS, FX.TEST_FROM, models=("random_forest",), forest_trees=5, forest_depth=4)
    names = [x.feature for x in r.importances.collect()]
    assert len(names) == 15 and any(n.startswith(("genre_", "category_")) for n in names)


def test_merged_profiles(spark):
    df = spark.createDataFrame([(i, float(i % 50) if i % 9 else None, f"s{i % 30}") for i in range(2_000)], "id int, x double, s string")
    whole = {r.column_name: r for r in SK.summarise(SK.profile_sketch(df, ["x", "s"])).collect()}
    parts = [SK.profile_sketch(df.where(F.col("id") % 3 == i), ["x", "s"]) for i in range(3)] + [SK.profile_sketch(df.limit(0), ["x", "s"])]
    merged = {r.column_name: r for r in SK.summarise(SK.merge_profiles(SK.merge_profiles(*parts[:2]), *parts[2:])).collect()}
    for c in ("x", "s"):
        a, b = whole[c], merged[c]
        assert (a.n, a.n_missing, a["min"], a["max"]) == (b.n, b.n_missing, b["min"], b["max"])
    assert merged["x"]["mean"] == pytest.approx(whole["x"]["mean"]) and merged["x"]["std"] == pytest.approx(whole["x"]["std"])
    assert abs(merged["s"].n_distinct - 30) <= 1 and abs(merged["x"].n_distinct - 50) <= 2 and abs(merged["x"].median - 25) <= 2
    assert merged["s"].median is None and merged["s"]["mean"] is None


def test_hot_keys_alone_are_salted(spark):
    df = spark.range(9_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string")).alias("developers"))
    counts = C.developer_counts(df)
    assert [r.developers for r in C.hot_keys(counts, "developers", "dev_game_count").collect()] == ["hot"]
    got = C.with_developer_count(df, broadcast_bytes=-1).groupBy("developers").agg(F.min("dev_game_count").alias("a"), F.max("dev_game_count").alias("b"), F.count("*").alias("n")).collect()
    assert all((r.a, r.b) == ((None, None) if r.developers is None else (r.n, r.n)) for r in got) and sum(r.n for r in got) == 9_000


def test_small_studios_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(C, "BROADCAST_MAX_BYTES", -1)
    df = spark.createDataFrame([(i, "hot") for i in range(50)] + [(99, "one"), (98, None)] + [(200 + i, "three") for i in range(3)], "id int, developers string")
    assert sorted(r.id for r in C.studio_size_filter(df).collect()) == [99, 200, 201, 202]


def labelled(spark):
    df = spark.range(600).select(F.col("id").alias("key"), (F.col("id") % 10).cast("double").alias("x"), ((F.col("id") * 7) % 5).cast("double").alias("z"))
    return VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df.withColumn("label", (F.col("x") > 5).cast("double"))).withColumn("weight", F.lit(1.0))


ESTIMATORS = {
    "svc": lambda: LinearSVC(), "linear": lambda: LinearRegression(), "pipeline": lambda: Pipeline(stages=[LinearSVC()]),
    "baseline": lambda: MO.RandomBaseline(), "logistic": lambda: MO.logistic(600.0), "forest": lambda: MO.forest(trees=3, max_depth=3),
    "boosted": lambda: MO.boosted(rounds=2, max_depth=2)}


@pytest.mark.parametrize("kind", ESTIMATORS)
def test_any_estimator_is_evaluated(spark, kind):
    estimator = ESTIMATORS[kind]()
    df = labelled(spark)
    done = PL.evaluate(estimator, df.where("key % 2 = floor(key / 10) % 2"), df.where("key % 2 <> floor(key / 10) % 2"), "m")
    assert done.predictions.columns == ["model", "key", "y", "proba", "pred"] and done.predictions.count() == 300
    got = {(r.split, r.metric): r.value for r in done.metrics().collect()}
    assert len(got) == 8 and (isinstance(estimator, MO.RandomBaseline) or got["test", "roc_auc"] > 0.95)


def test_a_fifth_model_is_one_line(spark, monkeypatch):
    f, spec = build_features(FX.games(spark, SMALL), key="game_id")
    monkeypatch.setitem(PL.ESTIMATORS, "linear_svc", lambda s: LinearSVC(weightCol="weight", maxIter=5))
    r = PL.train_and_evaluate(f, spec, "game_id", FX.TRAIN_YEARS, FX.TEST_FROM, models=("baseline", "linear_svc"))
    assert {x.model for x in r.comparison.collect()} == {"baseline", "linear_svc"}
    r = PL.train_and_evaluate(f, spec, "game_id", FX.TRAIN_YEARS, FX.TEST_FROM, models={"mine": LinearSVC(maxIter=3)})
    assert [x.model for x in r.comparison.collect()] == ["mine"]


def test_baseline_estimator_is_the_baseline(spark, tmp_path):
    df = labelled(spark)
    fitted = MO.RandomBaseline().fit(df)
    PipelineModel(stages=[fitted]).write().overwrite().save(str(tmp_path / "b"))
    for m in (fitted, PipelineModel.load(str(tmp_path / "b"))):
        got = MO.predictions(m, df, "baseline", "key").collect()
        want = MO.baseline_predictions(df, df.withColumn("y", F.col("label").cast("int")), "label", "key")
        assert {(r.key, r.proba, r.pred) for r in got} == {(r.key, r.proba, r.pred) for r in want.select("key", "proba", "pred").collect()}


def test_evaluator_area_and_reduced_curve(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = spark.range(2_000).select(F.lit("m").alias("model"), (F.rand(3) > 0.7).cast("int").alias("y"), F.round(F.rand(5), 2).alias("proba")).checkpoint()
    raw = df.select(F.col("proba").alias("rawPrediction"), F.col("y").cast("double").alias("label"))
    area = BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0).evaluate(raw)
    assert EV.curve_areas(df).first().pr_auc_spark == pytest.approx(area, abs=1e-12)
    straight = spark.createDataFrame([("m", 1, 0.9), ("m", 1, 0.8), ("m", 1, 0.7), ("m", 0, 0.6), ("m", 0, 0.5), ("m", 1, 0.4)], "model string, y int, proba double")
    kept = sorted(r.threshold for r in EV.roc_curve(straight, drop_intermediate=True).collect() if r.threshold is not None)
    assert kept == [0.4, 0.5, 0.7, 0.9]
