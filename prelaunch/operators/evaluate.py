"""Classifier evaluation over prediction tables (EVA1-EVA9, WIN1, MOD9, SET3).

A prediction table has one row per scored item: (group, y, score, pred),
``group`` usually the model name. Everything here is an aggregate or a
window over a bounded table; nothing is collected row by row.

Curves (WIN1) need cumulative counts in descending score order. They come
from :func:`prelaunch.operators.ranks.running_totals`: distinct scores are
cut into ranges, summed inside them and offset by the ranges above; no task
holds a whole group, and the input is read once.
Trapezoid areas then need no lag: the previous curve point of a score is
its cumulative count minus its own counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prelaunch.operators.ranks import BOUND, RANGES, running_totals
from prelaunch.plans.joins import broadcast_if_small
from prelaunch.session import checkpoint_dir


def _n(cond, weight: str | None) -> F.Column:
    """Rows (or summed ``weight``) meeting ``cond``."""
    if weight is None:
        return F.count_if(cond)
    return F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0)).cast("bigint")


def _counts(df: DataFrame, group: str, y: str, pred: str, weight: str | None = None) -> DataFrame:
    yy, pp = F.col(y), F.col(pred)
    return df.groupBy(group).agg(
        _n((yy == 1) & (pp == 1), weight).alias("tp"), _n((yy == 0) & (pp == 1), weight).alias("fp"),
        _n((yy == 1) & (pp == 0), weight).alias("fn"), _n((yy == 0) & (pp == 0), weight).alias("tn"))


def confusion(df: DataFrame, group: str = "model", y: str = "y", pred: str = "pred") -> DataFrame:
    """2x2 confusion counts per group, zero cells included (EVA1)."""
    c = _counts(df, group, y, pred)
    cells = F.explode(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(k).alias("n"))
        for a, p, k in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]]))
    return c.select(group, cells.alias("c")).select(group, "c.*")


def classification_metrics(df: DataFrame, group: str = "model", y: str = "y", pred: str = "pred",
                           weight: str | None = None) -> DataFrame:
    """Precision, recall, F1 per group; 0 where a denominator is 0 (EVA2).

    ``weight`` names a row-count column when ``df`` is already condensed.
    """
    c = _counts(df, group, y, pred, weight)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    zero = F.lit(0.0)
    return c.select(group, "tp", "fp", "fn", "tn",
                    F.coalesce(F.try_divide(tp.cast("double"), tp + fp), zero).alias("precision"),
                    F.coalesce(F.try_divide(tp.cast("double"), tp + fn), zero).alias("recall"),
                    F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), zero).alias("f1"))


def cumulative_by_score(df: DataFrame, group: str = "model", y: str = "y", score: str = "proba",
                        ranges: int = RANGES, weight: str | None = None, bound: int = BOUND) -> DataFrame:
    """Per (group, distinct score): pos, neg, cumulative pos/neg from the top, totals, and pos/neg of the next lower score (WIN1).

    Rows without a score or a 0/1 target take no part, neither in the curve
    nor in its totals.
    """
    yy = F.col(y)
    scored = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & yy.isin(0, 1))
    pts = scored.groupBy(group, F.col(score).cast("double").alias(score)).agg(_n(yy == 1, weight).alias("pos"), _n(yy == 0, weight).alias("neg"))
    checkpoint_dir(df.sparkSession)
    cum = running_totals(pts.checkpoint(), [group], score, {"pos": "cum_pos", "neg": "cum_neg"}, descending=True, ranges=ranges, bound=bound,
                         following={"pos": "next_pos", "neg": "next_neg"})
    return cum.select(group, score, "pos", "neg", "cum_pos", "cum_neg", F.col("cum_pos_all").alias("P"), F.col("cum_neg_all").alias("N"), "next_pos", "next_neg")


def _curve_points(cum: DataFrame) -> DataFrame:
    cp, cn, P, N = F.col("cum_pos"), F.col("cum_neg"), F.col("P"), F.col("N")
    pp, pn = cp - F.col("pos"), cn - F.col("neg")
    first = (pp + pn) == 0
    recall = F.when(P > 0, cp / P).otherwise(1.0)
    prev_recall = F.when(first, 0.0).when(P > 0, pp / P).otherwise(1.0)
    precision = cp / (cp + cn)
    prev_precision = F.when(first, 1.0).otherwise(pp / (pp + pn))
    return cum.select("*", precision.alias("precision"), recall.alias("recall"),
                      prev_precision.alias("prev_precision"), prev_recall.alias("prev_recall"),
                      F.when(N > 0, cn / N).alias("fpr"), F.when(P > 0, cp / P).alias("tpr"),
                      F.when(N > 0, pn / N).alias("prev_fpr"), F.when(P > 0, pp / P).alias("prev_tpr"))


def pr_curve(df: DataFrame, group: str = "model", y: str = "y", score: str = "proba") -> DataFrame:
    """Precision/recall per distinct threshold plus the (recall 0, precision 1) anchor (EVA3)."""
    pts = _curve_points(cumulative_by_score(df, group, y, score))
    curve = pts.select(group, F.col(score).alias("threshold"), "precision", "recall")
    anchor = pts.select(group).distinct().select(group, F.lit(None).cast("double").alias("threshold"),
                                                 F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return curve.unionByName(anchor)


def roc_curve(df: DataFrame, group: str = "model", y: str = "y", score: str = "proba", drop_intermediate: bool = False) -> DataFrame:
    """False/true positive rates per distinct threshold, from (0, 0) (EVA5).

    ``drop_intermediate`` leaves out points inside a straight stretch, those whose step from the point before equals the step
    to the next; the first and the last point stay, and the area is unchanged.
    """
    pts = _curve_points(cumulative_by_score(df, group, y, score))
    if drop_intermediate:
        first = F.col("cum_pos") + F.col("cum_neg") == F.col("pos") + F.col("neg")
        inside = F.col("next_pos").isNotNull() & (F.col("pos") == F.col("next_pos")) & (F.col("neg") == F.col("next_neg"))
        pts = pts.where(first | ~inside)
    curve = pts.select(group, F.col(score).alias("threshold"), "fpr", "tpr")
    start = pts.select(group).distinct().select(group, F.lit(None).cast("double").alias("threshold"),
                                                F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return curve.unionByName(start)


def curve_areas(df: DataFrame, group: str = "model", y: str = "y", score: str = "proba",
                weight: str | None = None) -> DataFrame:
    """Trapezoid areas: anchored PR-AUC (EVA4) and ROC-AUC (EVA6), and the PR area of Spark's evaluator.

    ``pr_auc`` integrates the curve including its (0, 1) anchor, as the
    usual precision_recall_curve + auc pairing does; for a constant score
    it equals (1 + prevalence) / 2. ``pr_auc_spark`` starts at recall 0 with
    the first point's precision instead (``BinaryClassificationEvaluator``
    without down-sampling); for a constant score it is the prevalence.
    """
    pts = _curve_points(cumulative_by_score(df, group, y, score, weight=weight))
    pr = (F.col("recall") - F.col("prev_recall")) * (F.col("precision") + F.col("prev_precision")) / 2
    first = F.col("cum_pos") + F.col("cum_neg") == F.col("pos") + F.col("neg")
    level = F.when(first, F.col("precision")).otherwise(F.col("prev_precision"))
    pr_spark = (F.col("recall") - F.col("prev_recall")) * (F.col("precision") + level) / 2
    roc = (F.col("fpr") - F.col("prev_fpr")) * (F.col("tpr") + F.col("prev_tpr")) / 2
    return pts.groupBy(group).agg(F.sum(pr).alias("pr_auc"),
                                  F.when((F.max("P") > 0) & (F.max("N") > 0), F.sum(roc)).alias("roc_auc"),
                                  F.sum(pr_spark).alias("pr_auc_spark"))


def comparison(df: DataFrame, group: str = "model", y: str = "y", score: str = "proba",
               pred: str = "pred", evaluator_area: bool = False) -> DataFrame:
    """One row per group: precision, recall, f1, pr_auc, roc_auc, with ``evaluator_area`` also pr_auc_spark (EVA7).

    The predictions are read once: condensed to (group, score, y, pred,
    rows) — at most four rows per distinct score — and checkpointed into the
    shared folder; metrics and curves both come from that table.
    """
    checkpoint_dir(df.sparkSession)
    base = df.groupBy(group, score, y, pred).agg(F.count(F.lit(1)).alias("__rows")).checkpoint()
    m = classification_metrics(base, group, y, pred, weight="__rows").select(group, "precision", "recall", "f1")
    a = curve_areas(base, group, y, score, weight="__rows")
    a = a if evaluator_area else a.drop("pr_auc_spark")
    return m.join(broadcast_if_small(a), group)


def stack_results(*tables: DataFrame) -> DataFrame:
    """Union of per-model result tables by column name (SET3)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def improvement(comp: DataFrame, baseline: str = "baseline", group: str = "model",
                metric: str = "precision") -> DataFrame:
    """Each group's metric divided by the baseline's (EVA8)."""
    base = comp.where(F.col(group) == baseline).agg(F.first(metric)).scalar()
    return comp.select(group, F.try_divide(F.col(metric), base).alias(f"{metric}_ratio"))


# The ROI scenario (per 1,000 games, 8.5% successes, $250,000
# development cost, 30% store cut, $1,000,000 / $50,000 gross revenue).
ROI_GAMES = 1000
ROI_SUCCESS_SHARE = 0.085
ROI_DEV_COST = 250_000
ROI_STORE_CUT = 0.30
ROI_SUCCESS_GROSS = 1_000_000
ROI_FAILURE_GROSS = 50_000


def roi(comp: DataFrame, group: str = "model", games: int = ROI_GAMES, success_share: float = ROI_SUCCESS_SHARE,
        dev_cost: float = ROI_DEV_COST, store_cut: float = ROI_STORE_CUT,
        success_gross: float = ROI_SUCCESS_GROSS, failure_gross: float = ROI_FAILURE_GROSS) -> DataFrame:
    """Return on investment of funding the games a model recommends (EVA9)."""
    actual = int(games * success_share)
    p, r = F.col("precision"), F.col("recall")
    tp = r * actual
    fp = F.when(p > 0, tp / p - tp).otherwise(0.0)
    invest = (tp + fp) * dev_cost
    net = tp * (success_gross * (1 - store_cut) - dev_cost) + fp * (failure_gross * (1 - store_cut) - dev_cost)
    return comp.select(group, "precision", "recall", tp.alias("true_positives"), fp.alias("false_positives"),
                       F.when(invest > 0, net / invest * 100).otherwise(0.0).alias("roi_pct"))


def choose_model(comp: DataFrame, group: str = "model") -> DataFrame:
    """The best row: highest precision, then F1, then name (MOD9)."""
    return comp.orderBy(F.desc("precision"), F.desc("f1"), F.asc(group)).limit(1)
