"""Language identification and toxicity: exact parts against brute force, learned parts on held-out rows."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prelaunch.llm import language_id as li
from prelaunch.llm import toxicity as tx
from prelaunch.llm.language_id import held_out

MEDIUM = "/root/testdata/sf0.01"
EDGE = [(1, None), (2, ""), (3, "123 !!! —"), (4, "the of and " * 30_000), (5, "und der die"), (5, "und der die"), (None, "the and"), (6, "x" * 5_000)]


def edge_docs(spark):
    return spark.createDataFrame([(i, t, "z", 0.5) for i, t in EDGE], "doc_id long, text string, lang_pred string, score double")


def test_forward_sums_all_segmentations():
    pieces = [" ", " t", "t", "h", "e", "th", "he", " the", "the"]
    prob = {p: 0.05 + 0.01 * i for i, p in enumerate(pieces)}
    model = li.LanguageModel(["a", "b"], pieces, np.array([[prob[p], prob[p] / 2] for p in pieces]), np.zeros(2))
    scorer = li.Scorer(model)
    import pyarrow as pa
    some, post = scorer.posteriors(pa.array(["the", "thé hethe", None, "12"]))
    assert some.tolist() == [True, True, False, False]
    for text, p in (("the", post[0]), ("thé hethe", post[1])):
        raw = np.array([np.prod([li.brute_force_word(" " + w, {k: v / s for k, v in prob.items()}) for w in text.split()]) for s in (1, 2)])
        assert np.allclose(p, raw / raw.sum())


def test_expected_counts_sum_to_segment_lengths():
    pieces = [" ", "a", "b", "ab", " a"]
    known = li.Pieces(pieces)
    codes = np.array([ord(c) for c in " abab"], np.uint64)
    out = np.zeros((5, 1))
    li.expected_counts(known, np.full((5, 1), 0.2), li.Pieces.sums(codes), np.array([0]), 5, np.array([[3.0]]), out)
    # every segmentation covers the five characters once, three times weighted
    assert np.isclose((out[:, 0] * [len(p) for p in pieces]).sum(), 15)


def test_language_query_held_out(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    got = li.op1_language_id(spark, MEDIUM).join(docs, "doc_id").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert 100 < len(held) < 300 and (held.lang == held.lang_pred).mean() > 0.98


def test_language_edge_cases(spark):
    train = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = li.fit(train.where(~li.held_out()), li.default_vocabulary(), fit_rows=300, rounds=1)
    got = sorted(str((r.doc_id, r.w_lang, r.lang_pred)) for r in li.predict(edge_docs(spark), model).collect())
    plain = {1: "und", 2: "und", 3: "und", 4: "en", 5: "de", None: "en"}
    assert [g for g in got if not g.startswith("(6")] == sorted(str((i, plain[i], "z")) for i, _ in EDGE if i != 6)
    empty = li.fit(train.limit(0), li.default_vocabulary())
    assert {r.w_lang for r in li.predict(edge_docs(spark), empty).collect()} == {"und"}
    assert li.predict(edge_docs(spark).limit(0), model).count() == 0


def plain_segments(s):
    """The definition: the best segment, then the same left and right of it."""
    def rec(a, b):
        best = None
        for i in range(a, b):
            t = 0.0
            for j in range(i, b):
                t += s[j]
                if t > 1e-9 and (best is None or t > best[0] + 1e-9):
                    best = (t, i, j + 1)
        return rec(a, best[1]) + [best[1:]] + rec(best[2], b) if best else []
    return rec(0, len(s))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.floats(-3, 3, allow_nan=False).map(lambda x: round(x, 3) + 0.00017 * (x > 0)), max_size=18))
def test_maximal_segments_score(s):
    got = tx.maximal_segments(np.array(s)) if s else []
    expected = plain_segments(s)
    # ties may be cut differently; the best score and the total agree
    total = lambda segs: round(sum(sum(s[a:b]) for a, b in segs), 6)
    assert total([(a, b) for a, b, _ in got]) == total(expected)


def test_lambda_and_curve():
    value, p = np.array([1.0, -1.0]), np.array([0.25, 0.75])
    assert np.isclose(tx.solve_lambda(value, p), np.log(3), atol=1e-6)
    x = np.array([0.0] * 90 + [5.0] * 10)
    a, b = tx.logistic_curve(x, (x > 0).astype(float))
    assert 1 / (1 + np.exp(-a)) < 0.1 and 1 / (1 + np.exp(-(a + 5 * b))) > 0.9


def test_toxicity_setting_is_chosen_inside_the_training_rows(spark):
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 5, 60).astype(float), rng.integers(0, 2, 60).astype(float)
    pairs = [(a > b) + 0.5 * (a == b) for a in x[y > 0] for b in x[y == 0]]
    assert np.isclose(tx.ranked_area(x, y), np.mean(pairs))
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    model = tx.fit(docs.where(~held_out()), labels.where(~held_out()))
    turned = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = tx.fit(docs.where(~held_out()), turned.where(~held_out()))
    assert model.setting in [(p, s) for p in tx.PRIORS for s in tx.SHRINKS]
    assert model.setting == again.setting and model.curve == again.curve and (model.scores == again.scores).all()


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    got = tx.op4_toxicity(spark, MEDIUM).join(labels, "doc_id").toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    held = got[got.held_out]
    hot, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert (clean.predicted == 0).mean() > 0.95
    auc = np.mean([(h > c) + 0.5 * (h == c) for h in hot.score for c in clean.score])
    assert auc > 0.85


def test_toxicity_edge_cases(spark):
    docs, labels = spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/labels.parquet")
    model = tx.fit(docs, labels.unionByName(labels.select("doc_id", "quality", F.lit(None).cast("int").alias("toxic"))))
    got = {str(r.doc_id): r.score for r in tx.find_passages(edge_docs(spark), model).collect()}
    assert len(got) == 7 and got["1"] == got["2"] == got["3"] < 0.5
    found = tx.find_passages(spark.createDataFrame([(1, "the of idiot moron trash scum and the of")], "doc_id long, text string"), model).first()
    assert found.score > 0.5 and len(found.passages) == 1 and found.passages[0]["first"] == 2
    none = tx.fit(docs, labels.limit(0))
    assert {r.score for r in tx.find_passages(edge_docs(spark), none).collect()} == {0.0}
    assert tx.find_passages(edge_docs(spark).limit(0), model).count() == 0
