"""Micro-table edge cases (FIXTURES.md §4)."""

import math

import pytest
from pyspark.sql import functions as F

from prelaunch.functions import lists as L
from prelaunch.functions import scalars as S
from prelaunch.functions import text as TX
from prelaunch.operators import evaluate as EV
from prelaunch.operators import profile as P


def col_values(df, c):
    return [r[c] for r in df.collect()]


def test_list_decode(spark):
    rows = [("['Action', 'Indie']",), ("[\"Director's Cut\", 'x']",), ("[]",), ("",), ("nan",),
            ("{'a': 1}",), ("('a','b')",), ("'abc'",), (None,), ("['a',]",), ("['a', None, True, 3]",)]
    df = spark.createDataFrame(rows, "v string")
    out = df.select(L.decode_list("v").alias("a")).collect()
    got = [r.a for r in out]
    assert got[0] == ["Action", "Indie"]
    assert got[1] == ["Director's Cut", "x"]
    assert got[2:9] == [[]] * 7
    assert got[9] == ["a"]
    assert got[10] == ["a", None, "True", "3"]


def test_comma_pieces_and_length(spark):
    df = spark.createDataFrame([(None,), ("[]",), ("['a','b']",)], "v string")
    assert col_values(df.select(L.comma_pieces("v").alias("n")), "n") == [0, 1, 2]
    assert col_values(df.select(L.list_length("v").alias("n")), "n") == [0, 0, 2]


def test_word_count(spark):
    df = spark.createDataFrame([("",), ("  a  b c\td ",), ("one",), (None,)], "v string")
    assert col_values(df.select(S.word_count("v").alias("n")), "n") == [0, 4, 1, 0]


def test_tokens(spark):
    df = spark.createDataFrame([("It's a Café-2D co-op x_y a bc",)], "v string")
    assert df.select(TX.tokens("v").alias("t")).first().t == ["it", "café", "2d", "co", "op", "x_y", "bc"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = col_values(df.select(TX.with_ngrams(F.col("t")).alias("g")), "g")
    assert got == [["a", "b", "c", "a b", "b c"], ["a"], []]


def test_date_parse(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024-02-03",), ("junk",)], "v string")
    got = col_values(df.select(F.date_format(S.parse_date("v"), "yyyy-MM-dd").alias("d")), "d")
    assert got == [None, "2024-02-03", None]


def test_price_bands(spark):
    df = spark.createDataFrame([(x,) for x in [-0.01, 0.0, 5.0, 5.01, 30.0, 100.0, 100.01, None]], "p double")
    got = col_values(df.select(P.band("p").alias("b")), "b")
    assert got == [None, "$0-5", "$0-5", "$5-10", "$20-30", "$30+", None, None]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 49.99, 50.0, -1.0, 51.0]], "p double")
    h = {r.bin: r["count"] for r in P.histogram(df, "p", 0.0, 50.0, 50).collect()}
    assert h[0] == 1 and h[49] == 2 and sum(h.values()) == 3 and len(h) == 50


def test_free_flag(spark):
    df = spark.createDataFrame([(0.0,), (None,), (1.0,)], "p double")
    assert col_values(df.select(S.is_free("p").alias("f")), "f") == [1, 1, 0]


def test_effect_labels(spark):
    df = spark.createDataFrame([(0.19,), (0.2,), (0.5,), (-0.8,)], "d double")
    assert col_values(df.select(S.effect_label("d").alias("e")), "e") == ["negligible", "small", "medium", "LARGE"]


def test_pct_difference(spark):
    df = spark.createDataFrame([(2.0, 3.0), (0.0, 3.0), (2.0, 0.0)], "a double, b double")
    got = col_values(df.select(S.pct_difference("a", "b").alias("d")), "d")
    assert got == [50.0, 0.0, None]


def test_missing_significance(spark):
    df = spark.createDataFrame([(None if i == 0 else i, None if i < 2 else i) for i in range(20)], "a int, b int")
    m = {r.column_name: r.missing_pct for r in P.missing_values(df).collect()}
    assert m == {"a": 5.0, "b": 10.0}
    assert [r.column_name for r in P.significant_missing(df).collect()] == ["b"]


def test_zero_denominators(spark):
    df = spark.createDataFrame([("m", 0, 0), ("m", 0, 0)], "model string, y int, pred int")
    r = EV.classification_metrics(df).first()
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)


def test_constant_column_correlation(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(10)], "a double, b double")
    c = {(r.var_a, r.var_b): r.corr for r in P.correlation_long(df, ["a", "b"]).collect()}
    assert c[("a", "b")] is None and c[("b", "b")] == pytest.approx(1.0)


def test_quartile(spark):
    df = spark.createDataFrame([(float(i), 0) for i in range(1, 8)], "x double, success int")
    m = P.class_moments(df, ["x"]).first()
    assert m.q1 == 2.5 and m.median == 4.0


def test_scaling_population_std(spark):
    from prelaunch.operators import encode as E
    df = spark.createDataFrame([(float(i),) for i in range(1, 8)], "x double")
    fs = E.fit_standard_scaler(df, ["x"])
    vals = col_values(fs.stage.transform(df), "num__x")
    assert vals[0] == pytest.approx(-1.5) and vals[-1] == pytest.approx(1.5)


def test_unseen_category(spark):
    from prelaunch.operators import encode as E
    train = spark.createDataFrame([(1,), (2,), (3,)], "c int")
    oh = E.fit_one_hot(train, ["c"])
    assert oh.names == ["c_2", "c_3"]
    test = spark.createDataFrame([(9,), (2,)], "c int")
    out = oh.stage.transform(test).collect()
    assert [(r.cat__c_2, r.cat__c_3) for r in out] == [(0.0, 0.0), (1.0, 0.0)]


def test_roi(spark):
    df = spark.createDataFrame([("rf", 0.494, 0.236), ("none", 0.0, 0.0)], "model string, precision double, recall double")
    r = {x.model: x.roi_pct for x in EV.roi(df).collect()}
    assert r["rf"] == pytest.approx(45.4, abs=0.1) and r["none"] == 0.0


def test_constant_score_pr_auc(spark):
    rows = [("b", 1 if i < 85 else 0, 0.3) for i in range(1000)]
    df = spark.createDataFrame(rows, "model string, y int, proba double")
    a = EV.curve_areas(df).first()
    assert a.pr_auc == pytest.approx((1 + 0.085) / 2) and a.roc_auc == pytest.approx(0.5)


def test_keyword_any(spark):
    df = spark.createDataFrame([("['Online PvP', 'Single-player']",), ("['Single-player']",), (None,)], "v string")
    assert col_values(df.select(L.any_keyword("v").alias("k")), "k") == [1, 0, 0]


def test_clean_tags(spark):
    df = spark.createDataFrame([("[' Action ', 'Indie', '', 'RPG', 'RPG']",)], "v string")
    assert df.select(L.clean_tags("v").alias("t")).first().t == ["Action", "RPG", "RPG"]


def test_list_decode_leaves_quoted_text_alone(spark):
    rows = ["['Yes, None, maybe']", "['a, True, b', 'c']", "['a'] junk", "['x'],", "[true, null]", r"['caf\xe9', 'tab\there', 'q\'s', 'ü', '\101']",
            "['a' 'b', \"c\"'d']", "['a',, 'b']", "[,'a']", "['a' 3]", "[-1.5e3, +2, None, False]", "[None]", "[['a']]", "['unclosed]", " [ 'a' ,\n'b' , ] ",
            "['" + "x" * 50_000 + "', " + "'y', " * 5_000 + "]"]
    expected = [["Yes, None, maybe"], ["a, True, b", "c"], [], [], [], ["café", "tab\there", "q's", "ü", "A"], ["ab", "cd"], [], [], [],
                ["-1.5e3", "+2", None, "False"], [None], [], [], ["a", "b"], ["x" * 50_000] + ["y"] * 5_000]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    out = df.select("i", L.decode_list("v").alias("a"), L.undecodable("v").alias("bad")).orderBy("i").collect()
    assert [r.a for r in out] == expected
    assert [r.bad for r in out] == [e == [] for e in expected]


def test_tag_names_stay_apart(spark):
    from prelaunch.operators.encode import assembler, feature_names, fit_one_hot, fit_standard_scaler
    from prelaunch.operators.tags import MultiHot
    df = spark.createDataFrame([("['a b', 'Action', 'Vol. 2']", 1.0), ("['a_b', 'action']", 2.0)], "tags string, `p.x` double")
    mh = MultiHot("tags", "t_").fit(df)
    wide = mh.transform(df)
    assert len(mh.columns) == len({c.lower() for c in mh.columns}) == 5
    got = [{t: r[c] for t, c in mh.names.items()} for r in wide.collect()]
    assert got == [{"Action": 1, "Vol. 2": 1, "a b": 1, "a_b": 0, "action": 0}, {"Action": 0, "Vol. 2": 0, "a b": 0, "a_b": 1, "action": 1}]
    oh, sc = fit_one_hot(wide, mh.columns), fit_standard_scaler(wide, ["p.x"])
    both = sc.stage.transform(oh.stage.transform(wide)).collect()
    assert len(oh.outputs) == 5 and len(both) == 2
    vec = fit_one_hot(wide, mh.columns, output="vector")
    num = fit_standard_scaler(wide.withColumnRenamed("p.x", "px"), ["px"])
    rows = assembler(num, vec).transform(vec.stage.transform(num.stage.transform(wide.withColumnRenamed("p.x", "px")))).collect()
    names = feature_names(num, vec)
    assert [len(r.features) for r in rows] == [len(names)] * 2


def test_wide_vocabularies_fit(spark):
    from prelaunch.operators.encode import fit_one_hot
    from prelaunch.operators.tags import MultiHot
    tags = spark.range(1200).select(F.concat(F.lit("['tag "), F.col("id").cast("string"), F.lit("']")).alias("tags"))
    mh = MultiHot("tags", "t_").fit(tags)
    v = mh.vector(tags, "v").collect()
    assert len(mh.tags) == 1200 and all(r.v.indices.tolist() == [mh.tags.index(r.tags[2:-2])] for r in v[:20])
    many = spark.range(10_005).select(F.when(F.col("id") > 0, F.col("id")).alias("c"))
    oh = fit_one_hot(many, ["c"], output="vector")
    out = {r.c: r["cat__0_vec"].indices.tolist() for r in oh.stage.transform(many.where("c is null or c < 4")).collect()}
    assert len(oh.names) == 10_004 and out == {1: [], 2: [0], 3: [1], None: [10_003]}


def test_csv_types(spark, tmp_path):
    from prelaunch.sources.games import read_games, read_raw, unparsable_counts
    (tmp_path / "g.csv").write_text("game_id,success,year,estimated_owners,price,extra.col\n1,1.0,2020.0,1e5,2.5,x\n2,0,2021,9007199254740993,x,y\n3,1.5,,,,z\n")
    rows = read_games(spark, str(tmp_path / "g.csv")).orderBy("game_id").collect()
    assert [(r.success, r.year, r.estimated_owners, r.price) for r in rows] == [(1, 2020, 100000, 2.5), (0, 2021, 9007199254740993, None), (None, None, None, None)]
    bad = {r.column_name: r.n_unparsable for r in unparsable_counts(read_raw(spark, str(tmp_path / "g.csv"))).collect()}
    assert bad == {"game_id": 0, "success": 1, "year": 0, "estimated_owners": 0, "price": 1}


def test_date_forms(spark):
    df = spark.createDataFrame([("2024-02-03 10:11:12",), ("Feb 3, 2024",), ("2024/02/03",), ("2024-02-03",), ("3 Feb, 2024",)], "v string")
    assert set(col_values(df.select(F.date_format(S.parse_date("v"), "yyyy-MM-dd").alias("d")), "d")) == {"2024-02-03"}


def test_null_scores_and_empty_inputs(spark):
    df = spark.createDataFrame([("m", 1, None), ("m", 0, 0.2), ("m", 1, 0.9)], "model string, y int, proba double")
    assert EV.curve_areas(df).first().roc_auc == 1.0
    empty = spark.createDataFrame([], "price double, windows boolean, success int, year int")
    assert {r.missing_pct for r in P.missing_values(empty).collect()} == {None}
    assert P.flag_totals(empty, ["windows"]).first().pct is None
    assert P.numeric_summary(empty, ["price"]).first()["median"] is None
    assert P.summary_stats(empty).first().total_games == 0


def test_exact_quantiles(spark):
    import numpy as np
    from prelaunch.operators.ranks import exact_quantiles
    rng = np.random.default_rng(3)
    data = {"a": rng.normal(size=500).round(1).tolist(), "b": [5.0] * 100, None: [1.0, 2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in [*vs, None]], "k string, v double")
    for ranges in (2, 32):
        got = {r.k: (r.q1, r.m) for r in exact_quantiles(df, ["k"], "v", {"q1": 0.25, "m": 0.5}, ranges=ranges).collect()}
        for k, vs in data.items():
            assert np.allclose(got[k], np.quantile(vs, [0.25, 0.5]))


def test_profile_tables(spark):
    df = spark.createDataFrame([(1.0, True, 1, 2020), (2.0, False, 0, 2021), (None, True, 0, 2021)], "price double, windows boolean, success int, year int")
    found = P.profile(df, numeric=["price"], flags=["windows"])
    assert found["size"].first().n_rows == 3 and found["summary"].first().total_games == 3
    assert {r.flag: r["count"] for r in found["flags"].collect()} == {"windows": 2}
    assert found["comparison"].where("metric = 'mean'").first().successful == 1.0


def test_developer_count_without_broadcast(spark, monkeypatch):
    from prelaunch.operators import cohort as C
    monkeypatch.setattr(C, "BROADCAST_MAX_BYTES", -1)
    df = spark.createDataFrame([(i, "hot" if i % 2 else None) for i in range(20)] + [(99, "one")], "id int, developers string")
    got = {r.id: r.dev_game_count for r in C.with_developer_count(df).collect()}
    assert got == {**{i: 10 if i % 2 else None for i in range(20)}, 99: 1}
