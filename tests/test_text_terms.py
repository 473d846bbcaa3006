"""Terms are cut once per text and counted by batches."""

from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from prelaunch.operators import text as TXO

ROWS = [(1, "the b a b a b"), (2, None), (3, ""), (4, "bb the bb cc bb cc"), (5, "cc"), (6, "bb the"), (6, "bb the"), (7, "the the")]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _expected(rows, stop, most):
    tf, df = Counter(), Counter()
    for _, text in rows:
        kept = [w for w in (text or "").split() if len(w) > 1 and w not in stop]
        terms = [" ".join(kept[i:i + n]) for n in range(1, most + 1) for i in range(len(kept) - n + 1)]
        tf.update(terms)
        df.update(set(terms))
    return {t: (df[t], tf[t]) for t in tf}


def test_terms_cut_the_text_once(spark):
    df = spark.createDataFrame(ROWS, "id long, v string")
    terms = df.select(TXO.Tfidf(stop_words=["the"]).terms(F.col("v")).alias("t"))
    assert _plan(terms).count("regexp_extract_all") == 1
    assert sorted(tuple(r.t) for r in terms.collect())[-1] == ("cc",)


def test_term_stats_equal_a_count_by_hand(spark):
    df = spark.createDataFrame(ROWS, "id long, v string")
    for most in (1, 2, 3):
        for stop in (["the"], []):
            stats = TXO.Tfidf(stop_words=stop, ngram_max=most).term_stats(df.repartition(3), F.col("v"))
            assert {r.term: (r.df, r.tf) for r in stats.collect()} == _expected(ROWS, stop, most)
            assert "Generate" not in _plan(stats)        # no row per occurrence
    assert TXO.Tfidf().term_stats(df.limit(0), F.col("v")).count() == 0


def test_a_batch_gives_each_term_once_also_in_parts(monkeypatch):
    lists = pa.RecordBatch.from_arrays([pa.array([(t or "").split() for _, t in ROWS], pa.list_(pa.string()))], ["t"])
    rows = [r for b in TXO.Tfidf(stop_words=["the"])._counter()([lists]) for r in b.to_pylist()]
    assert len(rows) == len({r["term"] for r in rows})
    monkeypatch.setattr(TXO, "BATCH_TOKENS", 4)
    monkeypatch.setattr(TXO, "BATCH_TERMS", 2)
    parts = Counter()
    for b in TXO.Tfidf(stop_words=["the"])._counter()([lists]):
        assert len(b) <= 2
        parts.update({r["term"]: r["n"] for r in b.to_pylist()})
    assert parts == {r["term"]: r["n"] for r in rows}
