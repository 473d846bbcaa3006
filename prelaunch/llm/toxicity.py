"""Toxic passages by maximum-scoring segment search.

* **Token log-odds.** Words, and word beginnings of 6, 5 and 4 characters as back-off for rare words, get the log-odds of
  occurring in toxic against clean texts (each text counts a unit once) under an informative Dirichlet prior (the pooled frequencies, worth
  a share ``prior`` of the corpus), shrunk towards 0 by ``shrink`` standard errors. A token scores the value of its most
  specific known unit minus ``DRIFT``, so that the expected score of clean text is negative. Prior and shrinkage are chosen from
  ``PRIORS`` x ``SHRINKS`` by cross-validation inside the training rows: texts are dealt into ``FOLDS`` by a hash of the text (copies
  stay together), scored by the odds of the other folds, and the setting that ranks toxic above clean texts best is taken.
* **Segments.** A linear-time scan finds all maximal-scoring segments of each text (the standard left-to-right scan
  over cumulative sums). Only tokens with a positive score open or extend a candidate, so the scan is sparse.
* **Extreme-value calibration.** For scores with negative drift the best segment of n clean tokens follows
  P(S < x) = exp(-K n exp(-lambda x)). lambda solves E[exp(lambda s)] = 1 over the tokens of clean training texts, K
  is its maximum-likelihood estimate from their best segments. A segment's E-value is K n exp(-lambda S); segments with
  E < ``E_MAX`` are the significant passages. A text's evidence is the sum of lambda S - ln(K n) over its segments, as
  far as positive, and a logistic curve fitted on the training texts turns it into a probability.

Learning reads the labelled training rows, at most about ``fit_rows`` of them, chosen by a hash of ``doc_id``. No other label enters
any constant.

Scale: labels of the bounded sample are broadcast, so learning does not shuffle texts; unit counts are summed in each
task before the shuffle; the model holds the units that ``MIN_COUNT`` or more texts of the bounded sample have. Scoring scans the texts
once (``mapInArrow``, no shuffle).

Edge cases: null and empty texts have no tokens and no evidence; they score like any text without evidence. Very long texts are
scanned whole, in time linear in their length. An empty table gives no rows. Ties between settings go to the first. Without
training labels of both kinds every score is 0; with fewer of one kind than folds the first setting is taken. Several labels of one ``doc_id`` count as toxic if any is. Rows with a null
``doc_id`` are scored but never learned from. Repeated rows score alike. Only ``doc_id`` and ``text`` (``doc_id`` and
``toxic`` of labels) are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm.language_id import held_out
from prelaunch.llm.words import FOLD, distinct_per_row, row_slices, small_batches, span_hash, spans, utf8

FIT_ROWS = 20_000
PRIORS = (0.05, 0.01, 0.25)
SHRINKS = (1.64, 1.0, 2.33)
FOLDS = 3
DRIFT = 0.1
MIN_COUNT = 4                # texts
E_MAX = 0.05
CLIP = 8.0
STEMS = (6, 5, 4)
BIN = 0.02                   # resolution of the score histogram that lambda is solved on


@dataclass
class ToxicityModel:
    units: np.ndarray        # sorted unit hashes
    scores: np.ndarray       # shrunken log-odds of each
    lam: float
    k: float
    curve: tuple[float, float]
    trained: bool = True
    setting: tuple[float, float] = (PRIORS[0], SHRINKS[0])


def tokens(texts):
    """Per slice: first row, last row, lower-cased bytes, starts and ends of words, index of each row's first word."""
    for first, last, part in row_slices(texts):
        data, rows_off = utf8(pc.utf8_lower(part))
        low = FOLD[data]
        yield first, last, low, *spans(low, rows_off)


def stem_ends(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, chars: int) -> np.ndarray:
    """End of the first ``chars`` characters of each word (the word's end if it is no longer)."""
    lead = np.flatnonzero((low & 0xC0) != 0x80)
    lead = np.append(lead, len(low))
    at = np.searchsorted(lead, starts) + chars
    return np.minimum(lead[np.minimum(at, len(lead) - 1)], ends)


def unit_hashes(low, starts, ends, level: int) -> np.ndarray:
    """Hash of each word's unit; level 0 is the whole word, 1.. the stems."""
    stop = ends if level == 0 else stem_ends(low, starts, ends, STEMS[level - 1])
    return span_hash(low, starts, stop) ^ np.uint64(0x9E3779B97F4A7C15 * level & (1 << 64) - 1)


def token_scores(model_units, model_scores, low, starts, ends) -> np.ndarray:
    """Score of each token before the drift: that of its most specific known unit, else 0."""
    at = known_units(model_units, low, starts, ends)
    return np.append(model_scores, 0.0)[at]


def known_units(model_units, low, starts, ends) -> np.ndarray:
    """Place of each token's most specific known unit; -1 without one."""
    out = np.full(len(starts), -1)
    left = np.arange(len(starts))
    for level in range(len(STEMS) + 1):
        if not len(left) or not len(model_units):
            break
        h = unit_hashes(low, starts[left], ends[left], level)
        at = np.minimum(np.searchsorted(model_units, h), len(model_units) - 1)
        ok = model_units[at] == h
        out[left[ok]] = at[ok]
        left = left[~ok]
    return out


def maximal_segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments [first, last) of a score sequence, in order, in time linear in its length."""
    total = np.concatenate([[0.0], np.cumsum(s)])
    first: list[int] = []
    last: list[int] = []
    left: list[float] = []
    right: list[float] = []
    link: list[int] = []                 # nearest earlier candidate with a smaller left sum
    for i in np.flatnonzero(s > 0).tolist():
        f, lo, hi = i, float(total[i]), float(total[i + 1])
        while True:
            j = len(first) - 1
            while j >= 0 and left[j] >= lo:
                j = link[j]
            if j < 0 or right[j] >= hi:
                break
            f, lo = first[j], left[j]    # joins everything from j on
            del first[j:], last[j:], left[j:], right[j:], link[j:]
        first.append(f)
        last.append(i + 1)
        left.append(lo)
        right.append(hi)
        link.append(j)
    return [(a, b, r - x) for a, b, x, r in zip(first, last, left, right)]


def segments_of(texts, units, scores):
    """Per text: number of tokens, its token scores, its maximal segments."""
    for _, _, low, starts, ends, rows in tokens(texts):
        s = token_scores(units, scores, low, starts, ends) - DRIFT
        for r in range(len(rows) - 1):
            own = s[rows[r]: rows[r + 1]]
            yield len(own), own, maximal_segments(own) if len(own) and own.max() > 0 else []


def evidence(n: int, segments, lam: float, k: float) -> float:
    """Sum of the segments' nats above the level that chance reaches in n tokens."""
    if not segments:
        return 0.0
    base = np.log(max(k * n, 1e-12))
    return float(sum(max(0.0, lam * x - base) for _, _, x in segments))


def training_rows(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """(text, toxic, fold) of a bounded sample of labelled rows."""
    labelled = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
                .agg(F.max("toxic").cast("int").alias("toxic")))
    n = labelled.count()
    share = min(1.0, fit_rows / max(n, 1))
    labelled = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))
    # about fit_rows small rows, whatever the table's size
    return docs.select("doc_id", "text").join(F.broadcast(labelled), "doc_id").select(
        "text", "toxic", F.pmod(F.xxhash64("text", F.lit(5)), F.lit(FOLDS)).cast("int").alias("fold"))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    rows = training_rows(docs, labels, fit_rows)

    def count(batches):
        for batch in batches:
            toxic, fold = batch.column("toxic").to_numpy(), batch.column("fold").to_numpy()
            for first, last, low, starts, ends, at in tokens(batch.column("text")):
                for level in range(len(STEMS) + 1):
                    # a text counts a unit once, however often it repeats it
                    h, own = distinct_per_row(unit_hashes(low, starts, ends, level), at)
                    group = np.repeat(fold[first:last] * 2 + toxic[first:last], np.diff(own)).astype(np.int64)
                    unit, back = np.unique(h, return_inverse=True)
                    n = np.bincount(back * 2 * FOLDS + group, minlength=len(unit) * 2 * FOLDS).reshape(len(unit), 2 * FOLDS)
                    yield pa.RecordBatch.from_arrays([pa.array(unit.view(np.int64)), pa.array(np.full(len(unit), level, np.int32)),
                                                      *[pa.array(n[:, g]) for g in range(2 * FOLDS)]], ["unit", "level", *GROUPS])

    counts = (small_batches(rows).mapInArrow(count, "unit long, level int, " + ", ".join(f"{g} long" for g in GROUPS)).groupBy("unit", "level")
              .agg(*[F.sum(g).alias(g) for g in GROUPS]))
    # units of the bounded sample
    got = counts.where(sum(F.col(g) for g in GROUPS) >= MIN_COUNT).toArrow()
    unit = got["unit"].to_numpy().view(np.uint64)
    order = np.argsort(unit)
    units, level = unit[order], got["level"].to_numpy()[order]
    clean, hot = (np.stack([got[f"n{2 * f + label}"].to_numpy()[order].astype(float) for f in range(FOLDS)]) for label in (0, 1))
    word = level == 0
    if not hot[:, word].sum() or not clean[:, word].sum():
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 1.0, 1.0, (0.0, 0.0), False)
    setting = _best_setting(rows, units, word, hot, clean)
    scores = log_odds(hot.sum(0), clean.sum(0), word, *setting)
    lam, k, curve = _calibrate(rows, units, scores)
    return ToxicityModel(units, scores, lam, k, curve, True, setting)


GROUPS = [f"n{i}" for i in range(2 * FOLDS)]     # texts per fold, clean and toxic


def log_odds(yt: np.ndarray, yc: np.ndarray, word: np.ndarray, prior: float, shrink: float) -> np.ndarray:
    """Shrunken log-odds of units from the numbers of toxic and clean texts that have them."""
    nt, nc = yt[word].sum(), yc[word].sum()
    if not nt or not nc:
        return np.zeros(len(yt))
    a0 = max(prior * (nt + nc), 100.0)
    a = np.maximum(a0 * (yt + yc) / (nt + nc), 1e-9)           # units that no text here has keep a trace of the prior
    delta = np.log((yt + a) / (nt + a0 - yt - a).clip(1)) - np.log((yc + a) / (nc + a0 - yc - a).clip(1))
    sigma = np.sqrt(1 / (yt + a) + 1 / (yc + a))
    score = np.sign(delta) * np.maximum(np.abs(delta) - shrink * sigma, 0)
    return np.clip(score, -CLIP, CLIP)


def _best_setting(rows: DataFrame, units: np.ndarray, word: np.ndarray, hot: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """The (prior, shrink) whose cross-validated evidence ranks the training rows best (area under the ROC curve)."""
    settings = [(p, s) for p in PRIORS for s in SHRINKS]
    # scores of every unit for a text of each fold, learned from the other folds
    held = np.stack([[log_odds(hot.sum(0) - hot[f], clean.sum(0) - clean[f], word, *s) for f in range(FOLDS)] for s in settings])
    held = np.concatenate([held, np.zeros((*held.shape[:2], 1))], 2)
    shared = rows.sparkSession.sparkContext.broadcast((units, held))

    def run(batches):
        units, held = shared.value
        for batch in batches:
            toxic, fold = batch.column("toxic").to_pylist(), batch.column("fold").to_pylist()
            out: list[tuple] = []
            bins: dict[tuple, int] = {}
            for first, _, low, starts, ends, at in tokens(batch.column("text")):
                known = known_units(units, low, starts, ends)
                for r in range(len(at) - 1):
                    own = known[at[r]: at[r + 1]]
                    if not len(own):
                        continue
                    for i in range(len(held)):
                        s = held[i, fold[first + r], own] - DRIFT
                        segs = [x for _, _, x in maximal_segments(s)] if s.max() > 0 else []
                        out.append((i, toxic[first + r], len(own), segs))
                        if not toxic[first + r]:
                            for b, c in zip(*np.unique(np.round(s / BIN).astype(int), return_counts=True)):
                                bins[i, int(b)] = bins.get((i, int(b)), 0) + int(c)
            out += [(i, -1, c, [float(b)]) for (i, b), c in bins.items()]               # histogram rows: bin and count
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()),
                                              pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.list_(pa.float64()))],
                                             ["setting", "toxic", "n", "segs"])

    # one small row for each setting and text of the bounded sample, and for each score bin of a batch
    got = rows.mapInArrow(run, "setting int, toxic int, n long, segs array<double>").toArrow().to_pylist()
    areas = []
    for i in range(len(settings)):
        _, _, _, x, y, _ = _calibrated([r for r in got if r["setting"] == i])
        if min(y.sum(), len(y) - y.sum()) < FOLDS:
            return settings[0]
        areas.append(ranked_area(x, y))
    return settings[int(np.argmax(areas))]


def ranked_area(x: np.ndarray, y: np.ndarray) -> float:
    """Share of pairs (label 1, label 0) that ``x`` puts in this order, ties half."""
    _, place, n = np.unique(x, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[place]
    hot = y > 0
    return float((rank[hot].sum() - hot.sum() * (hot.sum() + 1) / 2) / (hot.sum() * (~hot).sum()))


def _calibrate(rows: DataFrame, units: np.ndarray, scores: np.ndarray) -> tuple[float, float, tuple[float, float]]:
    shared = rows.sparkSession.sparkContext.broadcast((units, scores))

    def run(batches):
        units, scores = shared.value
        for batch in batches:
            toxic = batch.column("toxic").to_pylist()
            hist: dict[int, int] = {}
            n, segs = [], []
            for label, (size, s, found) in zip(toxic, segments_of(batch.column("text"), units, scores)):
                n.append(size)
                segs.append([x for _, _, x in found])
                if not label and size:
                    for b, c in zip(*np.unique(np.round(s / BIN).astype(int), return_counts=True)):
                        hist[int(b)] = hist.get(int(b), 0) + int(c)
            toxic += [-1] * len(hist)                              # histogram rows: bin and count
            n += list(hist.values())
            segs += [[float(b)] for b in hist]
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(n, pa.int64()), pa.array(segs, pa.list_(pa.float64()))],
                                             ["toxic", "n", "segs"])

    # one small row for each text of the bounded sample, and for each score bin of a batch
    got = rows.mapInArrow(run, "toxic int, n long, segs array<double>").toArrow().to_pylist()
    lam, k, _, _, _, curve = _calibrated(got)
    return lam, k, curve


def _calibrated(got: list[dict]) -> tuple:
    """lambda, K, the texts, their log evidence, their labels and the logistic curve, from rows (toxic, n, segs) of texts and,
    where ``toxic`` is -1, of the clean texts' score histogram."""
    hist: dict[float, int] = {}
    for r in got:
        if r["toxic"] < 0:
            hist[r["segs"][0] * BIN] = hist.get(r["segs"][0] * BIN, 0) + r["n"]
    lam = solve_lambda(np.array(list(hist)), np.array(list(hist.values()), float))
    docs = [r for r in got if r["toxic"] >= 0 and r["n"]]
    clean = [r for r in docs if not r["toxic"]]
    weight = sum(r["n"] * np.exp(-lam * max(r["segs"], default=0.0)) for r in clean)
    k = len(clean) / weight if weight else 1.0
    x = np.array([np.log1p(evidence(r["n"], [(0, 0, s) for s in r["segs"]], lam, k)) for r in docs])
    y = np.array([1.0 if r["toxic"] else 0.0 for r in docs])
    return lam, k, docs, x, y, logistic_curve(x, y) if len(x) else (0.0, 0.0)


def solve_lambda(value: np.ndarray, count: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1; 1 where no token scores above 0 (any level is significant then)."""
    if not len(value) or not (value > 0).any() or (value * count).sum() >= 0:
        return 1.0
    p = count / count.sum()
    lo, hi = 1e-6, 1.0
    while (p * np.exp(np.minimum(hi * value, 500))).sum() < 1 and hi < 64:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(mid * value, 500))).sum() < 1 else (lo, mid)
    return float(min(hi, 64.0))


def logistic_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve, by Newton steps with a small ridge."""
    w = np.zeros(2)
    d = np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        g = d.T @ (y - p) - 1e-3 * w
        h = (d * (p * (1 - p))[:, None]).T @ d + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0.0))


def find_passages(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, evidence, passages (first and last-plus-one token, score, E-value) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.units, model.scores, model.lam, model.k, model.curve, model.trained))
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())]))

    def run(batches):
        units, scores, lam, k, (a, b), trained = shared.value
        for batch in batches:
            out, ev, found = [], [], []
            for n, _, segs in segments_of(batch.column("text"), units, scores):
                e = evidence(n, segs, lam, k)
                ev.append(e)
                out.append(1 / (1 + np.exp(-np.clip(a + b * np.log1p(e), -30, 30))) if trained else 0.0)
                found.append([{"first": f, "last": l, "score": s, "e_value": k * n * float(np.exp(-lam * s))} for f, l, s in segs
                              if k * n * np.exp(-lam * s) < E_MAX])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64()), pa.array(ev, pa.float64()),
                                              pa.array(found, kind)], ["doc_id", "score", "evidence", "passages"])

    return small_batches(docs).select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, evidence double, passages array<struct<first:int,last:int,score:double,e_value:double>>")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages of every document."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs.where(~held_out()), labels.where(~held_out()))
    return (find_passages(docs, model)
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                    F.size("passages").cast("long").alias("n_passages")))
