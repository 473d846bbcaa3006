"""Merkle manifest against a plain recursion, its edge cases and its oracle."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from prelaunch.llm import merkle as mk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H([part(r["doc_id"]), part(r["source"]), part(r["lang"]), part(r["n_chars"]), part(text)])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(levels[-1][i: i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        f = i - i % 8
        out.append((nodes[f: i], nodes[i + 1: f + 8]))
        i //= 8
    return out


def brute_force(rows):
    groups = {}
    for r in rows:
        groups.setdefault("" if r["lang"] is None else "." + r["lang"], []).append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    names = sorted(groups, key=str.encode)
    trees = {k: tree([leaf(r, r["text"]) for r in groups[k]]) for k in names}
    forest = tree([trees[k][-1][0] for k in names])
    out = []
    for j, k in enumerate(names):
        for i, r in enumerate(groups[k]):
            steps = path(trees[k], i) + path(forest, j)
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for b, a in steps:
                node = H([*b, node, *a])
            root = forest[-1][0]
            out.append((r["doc_id"], leaf(r, r["text"]), trees[k][-1][0], root, H([x for b, a in steps for x in [*b, *a]]), node, node == root))
    return sorted(map(repr, out))


def run(spark, rows, levels, extra=False, top_nodes=mk.TOP_NODES):
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    if extra:
        for c in ("leaf", "w_tree", "pos", "n", "node", "root", "steps", "changed"):
            docs = docs.withColumn(c, F.lit("x"))
    leaves = mk.leaves_of(docs, F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", mk.UPPER, mk.LOWER))
    return mk.versions(mk.build(leaves, levels, top_nodes), levels)


def rows_of(df):
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())


def example(n):
    langs = [None, "", "en", "en", "en", "en", "é", "z"]
    return [{"doc_id": i if i % 17 else None, "text": [None, "", "plain", f"Text {i}", "ÄB" * 500][i % 5], "lang": langs[i % 8],
             "source": None if i % 3 else "s", "n_chars": None if i % 7 == 0 else i} for i in range(n)]


@pytest.mark.parametrize("n,levels,top", [(1, 3, 99), (1, 3, 0), (2, 1, 99), (9, 1, 4), (150, 1, 0), (150, 1, 60), (150, 3, 99), (700, 2, 0), (700, 1, 99)])
def test_manifest_equals_brute_force(spark, n, levels, top):
    rows = example(n) + example(min(n, 20))           # repeated rows are repeated leaves
    assert rows_of(run(spark, rows, levels, n == 150, top)) == brute_force(rows)


def test_many_languages_and_one_hot_language(spark):
    rows = [{"doc_id": i, "text": f"T{i}", "lang": "hot" if i % 2 else f"l{i}", "source": "s", "n_chars": 1} for i in range(300)]
    for top in (0, 100, 1_000):
        assert rows_of(run(spark, rows, 1, top_nodes=top)) == brute_force(rows)


def test_versions_share_what_is_off_the_path(spark):
    rows = [{"doc_id": i, "text": f"T{i}", "lang": "en", "source": "s", "n_chars": 1} for i in range(600)]
    got = run(spark, rows, 1).collect()
    changed = [r for r in got if r["copied"] is not None]
    assert len(changed) == sum(zlib.crc32(str(i).encode()) % 3 == 0 for i in range(600))
    assert all(len(r["copied"]) == 4 and r["copied"][-1] == r["folded_root"] and not r["verified"] for r in changed)
    assert all(r["verified"] for r in got if r["copied"] is None)


def test_manifest_of_nothing(spark):
    assert run(spark, [], 3).collect() == []


def test_manifest_nodes_are_the_tree(spark):
    rows = [{"doc_id": i, "text": str(i), "lang": "en", "source": "s", "n_chars": 1} for i in range(100)]
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    m = mk.build(mk.leaves_of(docs), 1, 0)
    levels = tree([leaf(r, r["text"]) for r in rows])
    assert {(r["round"], r["pos"]): r["node"] for r in m.nodes.collect()} == {(k, i): h for k, nodes in enumerate(levels) for i, h in enumerate(nodes)}


def test_manifest_query_on_more_levels(spark):
    con = duckdb.connect()
    con.sql("create view documents as from '/root/testdata/sf0.1/documents.parquet'")
    want = con.sql(mk.ORACLE_SQL)
    cols = want.columns
    got = mk.op11_merkle_manifest(spark, "/root/testdata/sf0.1").select(*cols).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, want.fetchall()))
