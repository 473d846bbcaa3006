"""Embedding near-duplicates and whitening against plain versions, and their edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from prelaunch.llm import embedding_dedup as ed
from prelaunch.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>"


def planted(seed=5, groups=12, dim=16, alone=120):
    """Loose and tight groups, chains, copies, and vectors around the threshold."""
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dim) for _ in range(alone)]
    for g in range(groups):
        centre = rng.normal(size=dim)
        out += [centre + rng.normal(size=dim) * (0.05 + 0.05 * g) for _ in range(4 + g)]
    out += [out[0] * 3] * 5 + [out[1]] * 40
    step = rng.normal(size=dim)
    out += [step + i * 0.35 * np.roll(step, 1) for i in range(8)]
    order = rng.permutation(len(out))
    return [(int(k) + 1, [float(x) for x in out[i]]) for k, i in enumerate(order)]


def dedup(spark, rows, **settings):
    got = ed.near_duplicates(spark.createDataFrame(rows, SCHEMA), **settings).collect()
    return sorted(map(tuple, got), key=repr)


@pytest.mark.parametrize("settings", [{}, {"list_rows": 20, "block": 16}, {"list_rows": 20, "block": 16, "sigmas": None}])
def test_dedup_equals_brute_force(spark, settings):
    rows = planted()
    want = sorted(ed.brute_force(rows), key=repr)
    assert sum(n for _, n, _, _ in want) > 1_000
    assert dedup(spark, rows, **settings) == want


def test_dedup_edge_cases(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (8, [10.0, 20.0]),
            (9, [1e300, 2e300]), (10, [1e-300, 2e-300]), (11, [-1.0, -2.0]), (12, [0.0, 1.0]), (13, [-0.0, 1.0]), (14, [1.0]), (15, [1.0, 2.0, 0.0]),
            (7, [1.0, 2.0]), (None, [1.0, 0.0]), (None, None), (16, [1e308, 1e308])]
    assert dedup(spark, rows) == sorted(ed.brute_force(rows), key=repr)
    assert dedup(spark, []) == []


def test_dedup_clashing_columns_and_floats(spark):
    rows = planted(groups=3, alone=10)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("embedding", F.col("embedding").cast("array<float>"))
    for c in ("cid", "w", "k1", "v", "dim", "list", "n", "to", "root", "component_id", "kept"):
        df = df.withColumn(c, F.lit("x"))
    exact = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, ed.near_duplicates(df).collect()), key=repr) == sorted(ed.brute_force(exact), key=repr)


def test_a_group_larger_than_a_block(spark):
    """One group of unlike near copies over many blocks, and one vector repeated."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=8)
    rows = [(i, [float(x) for x in centre + rng.normal(size=8) * 0.02]) for i in range(300)] + [(i, [1.0] + [0.0] * 7) for i in range(300, 500)]
    got = {r[0]: r[1:] for r in dedup(spark, rows, list_rows=50, block=32)}
    assert all(got[i] == (299, 0, i == 0) for i in range(300)) and all(got[i] == (199, 300, i == 300) for i in range(300, 500))


def test_recall_of_the_probes():
    """Links at the very threshold: the default probes find nearly all, and all of what is probed is found."""
    rng = np.random.default_rng(1)
    u = ed.unit(rng.normal(size=(6_000, 32)))
    other = ed.unit(rng.normal(size=u.shape))
    other = ed.unit(other - (other * u).sum(1, keepdims=True) * u)
    v = 0.901 * u + math.sqrt(1 - 0.901 ** 2) * other
    index = ed.Index.fit(u, 60)
    own, far = ed.nearest(u, index.centres), ed.nearest(v, index.centres)
    reach = math.sqrt(0.2)
    for limit, least in ((reach, 1.0), (reach * 4 / math.sqrt(32), 0.9995)):
        asked, back = index.probes(u, own, limit), index.probes(v, far, limit)
        found = [b in p if b >= a else a in q for a, b, p, q in zip(own, far, asked, back)]
        assert np.mean(found) >= least
    assert (own != far).mean() > 0.1
    # the coded bound holds for every pair
    _, codes, error = index.encode(v)
    for at in range(0, 60, 7):
        rows = np.flatnonzero(far == at)
        exact = np.sqrt(np.maximum(((u[rows][:, None] - v[rows][None]) ** 2).sum(2), 0))
        _, d = index.lookups(u[rows], at, codes[rows])
        assert (np.sqrt(np.maximum(d.T, 0)) <= exact + error[rows] + ed.SLACK).all()
        most = np.where(np.arange(len(rows)) % 2, 0.6, 0.0)
        kept, some = index.lookups(u[rows], at, codes[rows], most)
        assert (some == d[kept]).all() and (d > most[:, None]).all(1)[np.setdiff1d(np.arange(len(rows)), kept)].all() and len(kept) < len(rows)


def plain_whitening(rows):
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in rows], object)
    n, s = len(x), x.sum(0)
    c = (x * n - s).astype(float) / n
    cov = c.T @ c / n
    e, v = np.linalg.eigh(cov)
    return n, ((x * n - s) ** 2).sum(1), c, cov, e[::-1], v[:, ::-1]


def test_whitening_equals_plain(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=12) * np.arange(1, 13)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(200)]
    n, dev, c, cov, e, v = plain_whitening(rows)
    got = wh.whiten(spark.createDataFrame(rows, SCHEMA).repartition(40)).collect()
    assert len(got) == 8 * len(rows)
    z = np.zeros((len(rows), 8))
    for r in got:
        assert r["n"] == n and r["deviation"] == dev[r["vec_id"]]
        assert abs(r["explained"] - e[r["component"] - 1] / np.trace(cov)) < 1e-9 and r["identity_error"] < 1e-9
        z[r["vec_id"], r["component"] - 1] = r["whitened"]
    want = c @ v[:, :8] / np.sqrt(e[:8])
    sign = np.sign((z * want).sum(0))
    assert np.abs(z - want * sign).max() < 1e-9
    # equal vectors are whitened alike
    assert (z[7] == z[400:]).all()


def test_covariance_merges_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(wh, "FAN_IN", 3)
    monkeypatch.setattr(wh, "STRIP", 5)
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.normal(size=12) * 50]) for i in range(300)] + [(i, [1.0, float(i)]) for i in range(9)]
    _, classes = wh.classes_of(spark.createDataFrame(rows, SCHEMA))
    sums = wh.dimension_sums(classes)
    found = wh.covariances(classes.repartition(30), sums)
    for dim, some in ((12, rows[:300]), (2, rows[300:])):
        n, _, _, cov, *_ = plain_whitening(some)
        assert sums[dim][0] == n and np.abs(found[dim] - cov).max() <= 1e-12 * np.abs(cov).max()


def test_whitening_weights_one(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(50)]
    once = wh.whiten(spark.createDataFrame(rows, SCHEMA)).where("vec_id = 3").collect()
    many = wh.whiten(spark.createDataFrame(rows + [rows[0]] * 30, SCHEMA), weights="one").where("vec_id = 3").collect()
    key = lambda r: [(x["component"], x["n"], x["deviation"], round(x["whitened"], 9)) for x in sorted(r, key=lambda x: x["component"])]
    assert key(once) == key(many)
    with pytest.raises(ValueError):
        wh.whiten(spark.createDataFrame(rows, SCHEMA), weights="two")


def test_whitening_edge_cases(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [1.0, 2.0]), (7, [3.0, -1.0]), (7, [3.0, -1.0]), (None, [0.5, 0.25]),
            (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("x", "w", "k1", "k2", "z", "n", "dim", "deviation", "component"):
        df = df.withColumn(c, F.lit("x"))
    got = wh.whiten(df).collect()
    assert sorted(((r["vec_id"] or 0, r["component"]) for r in got)) == [(0, 1), (0, 2), (6, 1), (6, 2), (7, 1), (7, 1), (7, 2), (7, 2), (8, 1), (8, 2), (8, 3)]
    n, dev, *_ = plain_whitening([r for r in rows if r[1] and len(r[1]) == 2 and all(x is not None and math.isfinite(x) for x in r[1])])
    assert n == 4 and sorted({(r["vec_id"] or 0, r["deviation"]) for r in got if r["vec_id"] != 8}) == sorted({(0, dev[3]), (6, dev[0]), (7, dev[1])})
    # a single vector has no variance
    assert all(r["whitened"] is None and r["explained"] is None and r["n"] == 1 and r["deviation"] == 0 for r in got if r["vec_id"] == 8)
    assert wh.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whitening_of_large_entries(spark):
    """Deviations are exact beyond doubles and null beyond longs; entries beyond a long are held at its border."""
    some = [(i, [float(i) * 1e4, float(i % 3)]) for i in range(10)]
    n, dev, *_ = plain_whitening(some)
    got = {r["vec_id"]: r["deviation"] for r in wh.whiten(spark.createDataFrame(some, SCHEMA)).collect()}
    assert got == {i: int(dev[i]) for i in range(10)}
    got = wh.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], SCHEMA)).collect()
    assert len(got) == 6 and {r["deviation"] for r in got if r["vec_id"] == 1} == {None}


def test_whitening_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    n, dev, c, cov, e, v = plain_whitening(rows)
    at = {r[0]: i for i, r in enumerate(rows)}
    got = wh.op13_whitening(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 8 * n and all(r["deviation"] == dev[at[r["vec_id"]]] for r in got)
    z = np.zeros((n, 8))
    for r in got:
        z[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    want = c @ v[:, :8] / np.sqrt(e[:8])
    assert np.abs(np.abs(z) - np.abs(want)).max() < 1e-8
