"""Train and evaluate models on a temporal split (MOD6, UDF4, SPL1, AGG22, SNK3-5).

:func:`evaluate` takes any Spark ML estimator. The named ones of a run are a table, ``ESTIMATORS``: a further model is one
more entry, or an estimator passed by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prelaunch.functions import scalars as S
from prelaunch.functions.scalars import quoted
from prelaunch.operators import cohort as C
from prelaunch.operators import encode as E
from prelaunch.operators import evaluate as EV
from prelaunch.operators import models as M
from prelaunch.operators.deep_forest import DeepForest
from prelaunch.plans.features import FeatureSpec, build_features
from prelaunch.session import checkpoint_dir

ROWS_PER_TASK = 500_000      # rows a task of an iterative fit is worth on a large input: 200 rounds of depth 6 are 1,200 passes of so many tasks, twice
NARROW_ROWS = 200_000        # the same for rows of a few features
LEAST_ROWS = 2_000           # and the rows below which one more task costs more than it does
THREE = ("precision", "recall", "f1")


@dataclass
class FitSettings:
    """What the named estimators need to know of a run."""
    key: str
    weight_sum: float
    forest_trees: int = 100
    forest_depth: int = M.MAX_DEPTH
    boost_rounds: int = 200


# A further model of a run is one more line.
ESTIMATORS: dict[str, Callable[[FitSettings], Estimator]] = {
    "baseline": lambda s: M.RandomBaseline(keyCol=s.key),
    "logistic_regression": lambda s: M.logistic(s.weight_sum),
    "random_forest": lambda s: DeepForest(M.forest(trees=s.forest_trees, max_depth=s.forest_depth)),
    "gradient_boosting": lambda s: M.boosted(weight="pos_weight", rounds=s.boost_rounds),
}
MODEL_NAMES = tuple(ESTIMATORS)
SAVED_MODEL = "random_forest"


@dataclass
class Evaluation:
    """One evaluated model: the fitted model, its test predictions (model, key, y, proba, pred), and its training metrics
    (model, split, metric, value)."""
    model: object
    predictions: DataFrame
    train_metrics: DataFrame

    def metrics(self) -> DataFrame:
        """(model, split, metric, value): precision, recall and F1 of both splits, and the areas of the test split."""
        test = _long(EV.comparison(self.predictions), "test", (*THREE, "pr_auc", "roc_auc"))
        return EV.stack_results(self.train_metrics, test)


def evaluate(estimator: Estimator, train: DataFrame, test: DataFrame, name: str | None = None, key: str = "key", label: str = "label",
             threshold: float = 0.5) -> Evaluation:
    """Fit any Spark ML estimator on ``train`` and judge it on ``test`` (MOD6).

    The estimator may be a classifier, a regressor (its prediction is the score, positive from ``threshold`` on), a pipeline or a
    search over parameters; which columns hold its scores follows from its params. The baseline's training metrics are analytic (MOD2).
    """
    name = name or type(estimator).__name__
    fitted = estimator.fit(train)
    transform = M.transformer(fitted, train.sparkSession)
    if isinstance(estimator, M.RandomBaseline):
        seen = M.baseline_train_metrics(train, label).withColumn("model", F.lit(name))
    else:
        seen = EV.classification_metrics(M.predictions(fitted, train, name, key, label, threshold, transform))
    return Evaluation(fitted, M.predictions(fitted, test, name, key, label, threshold, transform), _long(seen, "train", THREE))


@dataclass
class Results:
    """Tidy results of one run (SNK3 tables)."""
    predictions: DataFrame       # (model, key, y, proba, pred) on the test rows
    metrics: DataFrame           # (model, split, metric, value)
    comparison: DataFrame        # one row per model (EVA7)
    importances: DataFrame | None
    data_info: DataFrame         # AGG22 split report
    model: PipelineModel | None  # preprocessing + forest (the saved model)


def split_report(df: DataFrame, label: str, spec: FeatureSpec) -> DataFrame:
    """Rows and success rate per split, plus feature counts (AGG22)."""
    return (df.where(F.col("split") != "none").groupBy("split")
            .agg(F.count(F.lit(1)).alias("rows"), F.avg(F.col(label).cast("double")).alias("success_rate"))
            .withColumns({"num_features": F.lit(len(spec.numerical_features)),
                          "cat_features": F.lit(len(spec.categorical_features)),
                          "total_features": F.lit(len(spec.numerical_features) + len(spec.categorical_features))}))


def _materialise(df: DataFrame) -> DataFrame:
    """Cut lineage: write to the shared checkpoint folder, from where later jobs read."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_split(df: DataFrame, spec: FeatureSpec, key: str, train_years=C.TRAIN_YEARS, test_from: int = C.TEST_FROM,
               test_fraction: float = 0.3) -> DataFrame:
    """``split`` by release year where the spec's time column exists (SPL1), else stratified at random (SPL2)."""
    if spec.temporal_column in df.columns:
        return C.temporal_split(df, spec.temporal_column, train_years, test_from)
    return E.stratified_split(df, spec.target, key, test_fraction)


def _long(metrics: DataFrame, split: str, names: tuple[str, ...]) -> DataFrame:
    cells = F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*names)))
    return metrics.select("model", F.lit(split).alias("split"), cells.alias("metric", "value"))


def fit_tasks(rows: int, cores: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Tasks for an iterative fit: all cores as soon as the rows are worth it, more on large inputs."""
    return max(1, min(cores, rows // LEAST_ROWS), -(-rows // rows_per_task))


def dealt(df: DataFrame, rows_per_task: int = NARROW_ROWS) -> DataFrame:
    """The rows of a materialised table, dealt out for an iterative fit, so that a task's share does not grow with the table."""
    return df.repartition(fit_tasks(df.count(), df.sparkSession.sparkContext.defaultParallelism, rows_per_task))


def train_and_evaluate(features: DataFrame, spec: FeatureSpec, key: str,
                       train_years=C.TRAIN_YEARS, test_from: int = C.TEST_FROM,
                       models=MODEL_NAMES, forest_trees: int = 100, forest_depth: int = M.MAX_DEPTH,
                       boost_rounds: int = 200, with_importances: bool = True, one_hot: str = "vector") -> Results:
    """Fit and score the chosen models (MOD6).

    ``models`` are names of ``ESTIMATORS``, or a mapping of names to estimators on ``features``, ``label`` and the weights
    ``weight`` (balanced) and ``pos_weight``. ``one_hot`` is the encoder's output form: a sparse vector per column by
    default, ``"columns"`` for a 0/1 column per category.
    """
    spark = features.sparkSession
    label = spec.target
    cols = spec.numerical_features + spec.categorical_features
    C.leakage_guard([*cols, *spec.vector_features])
    data = with_split(C.target_not_null(features, label), spec, key, train_years, test_from)
    # One lineage cut: every fit below (scaler, categories, weights, models)
    # reads this table instead of re-deriving the features.
    data = _materialise(data.select(key, F.col(label).cast("double").alias("label"), "split",
                                    *[F.col(quoted(c)) for c in [*cols, *spec.vector_features]]))
    train = data.where(F.col("split") == "train")
    test = data.where(F.col("split") == "test")

    scaler = E.fit_standard_scaler(train, spec.numerical_features)
    onehot = E.fit_one_hot(train, spec.categorical_features, output=one_hot)
    prep = PipelineModel(stages=[*scaler.stages, *onehot.stages, E.assembler(scaler, onehot, vectors=list(spec.vector_features))])
    names = E.feature_name_table(spark, scaler, onehot, {c: spec.name_tables.get(c, names) for c, names in spec.vector_features.items()})
    weights = E.balanced_weights(train, "label")
    pos_w = E.positive_weight(train, "label")
    keep = [key, "label", "features"]
    # Iterative fits read the assembled vectors many times: cached, dealt by key over the cores.
    n_train = train.count()
    train_v = prep.transform(train).select(*keep).repartition(fit_tasks(n_train, spark.sparkContext.defaultParallelism), key).withColumns({
        "weight": E.weight_column("label", weights),
        "pos_weight": E.weight_column("label", {1.0: pos_w, 0.0: 1.0})}).persist(StorageLevel.MEMORY_AND_DISK)
    test_v = prep.transform(test).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)

    if isinstance(models, Mapping):
        estimators = dict(models)
    else:
        settings = FitSettings(key, train_v.agg(F.sum("weight")).first()[0] or 1.0, forest_trees, forest_depth, boost_rounds)
        estimators = {name: ESTIMATORS[name](settings) for name in models}
    preds, metric_rows, imp, saved = [], [], None, None
    for name, estimator in estimators.items():
        done = evaluate(estimator, train_v, test_v, name, key)
        preds.append(done.predictions)
        metric_rows.append(done.train_metrics)
        if name == SAVED_MODEL:
            saved = PipelineModel(stages=list(prep.stages) + [done.model])
            if with_importances:
                imp = M.importances(spark, done.model, names)
    # results are small or written once; after these two the cached vectors can go
    pred = _materialise(EV.stack_results(*preds))
    train_metrics = _materialise(EV.stack_results(*metric_rows))
    train_v.unpersist()
    test_v.unpersist()
    comp = EV.comparison(pred)
    metrics = EV.stack_results(train_metrics, _long(comp, "test", (*THREE, "pr_auc", "roc_auc")))
    return Results(pred, metrics, comp, imp, split_report(data, "label", spec), saved)


def run(games: DataFrame, path: str, key: str = "game_id", target: str = "success", train_years=C.TRAIN_YEARS,
        test_from: int = C.TEST_FROM, date_formats: tuple[str, ...] = S.DATE_FORMATS, tfidf=None, **settings) -> Results:
    """The whole life cycle: features, split, four models, results; everything is written under ``path``.

    ``features`` (SNK1), ``spec`` (SNK2), ``results/*`` (SNK3), ``predictions`` (SNK4), ``model`` (SNK5). Vocabularies
    are learned from the training period where there is a release date, else from all rows.
    """
    from prelaunch.sources import sinks

    games = _materialise(games)
    fit_on = games
    if "release_date" in games.columns:
        fit_on = C.train_rows(C.with_release_parts(games, formats=date_formats), train_years=train_years)
    features, spec = build_features(games, fit_on=fit_on, key=key, date_formats=date_formats, tfidf=tfidf)
    spec.target = target
    sinks.write_features(features, f"{path}/features")
    spec.write(games.sparkSession, f"{path}/spec")
    found = train_and_evaluate(sinks.read_features(games.sparkSession, f"{path}/features"), spec, key, train_years, test_from, **settings)
    sinks.write_results({"metrics": found.metrics, "comparison": found.comparison, "importances": found.importances,
                         "confusion": EV.confusion(found.predictions), "data_info": found.data_info}, f"{path}/results")
    sinks.write_predictions(found.predictions, f"{path}/predictions")
    if found.model is not None:
        sinks.save_model(found.model, f"{path}/model")
    return found
