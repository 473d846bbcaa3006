"""Decontamination, n-gram join and token counts against brute force and the tokenizer library."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from prelaunch.llm import decontaminate as dc
from prelaunch.llm import ngram_join as nj
from prelaunch.llm import token_counts as tc
from prelaunch.llm.components import components
from prelaunch.llm.words import slices, utf8, word_hashes

SF = "/root/testdata/sf0.001"
TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
LONG = "alpha beta gamma delta " * 20_000
EDGE = [(1, None), (2, ""), (3, "!!! ..."), (4, LONG), (5, "one two"), (5, "one two"), (None, "one two three four five six"),
        (6, "One TWO"), (7, "été ÉTÉ 42 x")]


def edge_docs(spark, rows=EDGE):
    """doc_id, text and columns whose names clash with results."""
    out = [(i, t, "x", 1.5, True, [1]) for i, t in rows]
    return spark.createDataFrame(out, "doc_id long, text string, class_id string, score double, contaminated boolean, spans array<int>")


def test_word_hashes_follow_words():
    data, off = utf8(pa.array(["ab cd", None, "AB-cd", "é x", "cdab"]))
    h, s, e, rows = word_hashes(data, off)
    assert rows.tolist() == [0, 2, 2, 4, 6, 7]
    assert h[0] == h[2] and h[1] == h[3] and len({int(x) for x in h}) == 5
    assert [r[:2] for r in slices(data, off, 4)][-1][1] == 5


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "cc", "A", "é"]), max_size=30), max_size=6),
       st.lists(st.lists(st.sampled_from(["a", "b", "cc"]), max_size=18), max_size=4), st.integers(1, 5))
def test_wu_manber_equals_plain_search(texts, items, width):
    texts = [" ".join(t) for t in texts]
    pairs = [(str(i), " ".join(t)) for i, t in enumerate(items)]
    found = dc.search_batch(pa.array(texts, pa.string()), dc.compile_tables(pairs, width))
    expected = dc.brute_force(texts, pairs, width)
    assert [(n, sum(b - a for a, b in s)) for n, _, s in found] == [x[:2] for x in expected]
    assert [len(i) for _, i, _ in found] == [sum(any(w in windows(t, width, len(w)) for w in windows_of(p, width)) for _, p in pairs) for t in texts]


def windows_of(text, width):
    w = text.lower().split()
    return [tuple(w[i: i + width]) for i in range(max(1, len(w) - width + 1))] if w else []


def windows(text, width, n):
    w = [x.replace("A", "a") for x in text.split()]
    return {tuple(w[i: i + n]) for i in range(len(w) - n + 1)}


def test_decontaminate_edge_cases(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta " * 4), (2, "one two"), (2, "one two"), (None, "x"), (3, None), (4, "...")],
                                  "item_id long, text string")
    docs = edge_docs(spark)
    got = sorted(map(str, ((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in dc.decontaminate(docs, items).collect())))
    expected = sorted(map(str, [(1, 0, 0, [], False), (2, 0, 0, [], False), (3, 0, 0, [], False), (4, 80_000, 80_000, ["1"], True),
                                (5, 2, 2, ["2"], True), (5, 2, 2, ["2"], True), (None, 6, 2, ["2"], True), (6, 2, 2, ["2"], True),
                                (7, 4, 0, [], False)]))
    assert got == expected
    # several pattern blocks give the same
    again = dc.decontaminate(docs, items, block_bytes=20)
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in again.collect()))) == expected
    assert dc.decontaminate(docs, items.limit(0)).where("contaminated").count() == 0
    assert dc.decontaminate(docs.limit(0), items).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 3), (5, 4), (5, 4), (9, 8), (8, 7), (7, 6), (6, 10)], "u long, v long")
    assert {r.node: r.root for r in components(edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6, 9: 6, 10: 6}
    assert components(edges.limit(0)).count() == 0


def test_components_with_a_hub_and_many_small_ones(spark):
    rng = random.Random(1)
    edges = [(7, 10_000 + i) for i in range(3_000)] + [(50_000 + 3 * i, 50_000 + 3 * i + 1) for i in range(3_000)] + [(50_000 + 3 * i, 50_000 + 3 * i + 2) for i in range(2_000)]
    edges += [(10_005, 50_000), (50_004, 50_010)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = top(u), top(v)
        parent[max(a, b)] = min(a, b)
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: top(x) for x in parent}


def near_copies(seed=3):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(rnd.choice([6, 40, 150]))]
        for _ in range(rnd.choice([1, 2, 6])):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                t[rnd.randrange(len(t))] = word()
            rows.append((n, " ".join(t)))
            n += 1
    return rows + [(n, rows[0][1].upper()), (n + 1, None), (n + 2, ""), (n + 3, "a b"), (n + 4, "A, b!")]


def test_ngram_join_equals_brute_force(spark):
    rows = near_copies()
    docs = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, w_root string")
    expected = nj.brute_force(rows)
    assert any(n for _, _, n in expected.values())
    for settings_ in ({}, {"block_shingles": 200}):              # groups split into pairs of blocks
        got = {r.doc_id: (r.class_id, r.n_copies, r.n_links) for r in nj.ngram_join(docs, **settings_).collect()}
        assert got == expected


def test_ngram_join_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = nj.brute_force(rows)
    got = {r.doc_id: (r.class_id, r.n_copies, r.n_links) for r in nj.op9_ngram_join(spark, SF).collect()}
    assert got == expected
    kept = nj.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _, _ in expected.values()})


def test_ngram_join_edge_cases(spark):
    docs = edge_docs(spark)
    got = sorted(str((r.doc_id, r.class_id, r.n_copies, r.n_links)) for r in nj.ngram_join(docs).collect())
    assert got == sorted(map(str, [(1, 1, 1, 0), (2, 2, 1, 0), (3, 3, 1, 0), (4, 4, 1, 0), (5, 5, 3, 0), (5, 5, 3, 0), (None, None, 1, 0),
                                   (6, 5, 3, 0), (7, 7, 1, 0)]))
    kept = nj.keep_representatives(docs)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, None, 7]))
    assert nj.ngram_join(docs.limit(0)).count() == 0 and nj.keep_representatives(docs.limit(0)).count() == 0


def test_many_short_near_copies_stay_small():
    # two blocks of short texts that are all alike: memory follows the links, not classes x classes of eight bytes
    import tracemalloc
    n, needed = 1200, nj.needed_matches(16, 112, 0.8, 1e-6)
    sets = [list(range(1, 11)) if i % 2 else [*range(1, 10), 100 + i] for i in range(n)]
    sh = np.array([x for s in sets for x in s], np.uint64)
    sig = nj.signatures(sh * np.uint64(0x9E3779B97F4A7C15), np.arange(n + 1) * 10, 112)
    table = pa.table({"w_class": pa.array([b"%05d" % i for i in range(n)], pa.binary()), "own": pa.array([i % 2 for i in range(n)], pa.int32()),
                      "low": pa.array([0] * n, pa.int32()), "high": pa.array([1] * n, pa.int32()),
                      "w_sig": pa.array([x.astype("<u4").tobytes() for x in sig], pa.binary()),
                      "w_sh": pa.array([np.array(s, "<u8").tobytes() for s in sets], pa.binary())})
    tracemalloc.start()
    got = nj.link_task(table, 28, 4, 16, 0.8, needed).to_pydict()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got["w_class"] == [b"%05d" % i for i in [*range(0, n, 2), *range(1, n, 2)]]
    assert set(got["n_links"]) == {n // 2} and set(got["w_to"]) == {b"00000"}
    assert peak < 8 * n * n


def test_blocks_are_bounded_by_classes(spark):
    base = "a b c d e f g h i j k l m n".split()
    rows = [(i, " ".join([*base[:-1], f"w{i}"])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    task = nj.link_task

    def counted(table, *a):
        assert table.num_rows <= 30, table.num_rows
        return task(table, *a)

    nj.link_task = counted
    try:
        got = {r.doc_id: (r.class_id, r.n_copies, r.n_links) for r in nj.ngram_join(docs, block_classes=8).collect()}
    finally:
        nj.link_task = task
    assert got == nj.brute_force(rows)


def test_pruning_never_drops_likely_pairs():
    needed = nj.needed_matches(16, 112, 0.8, 1e-6)
    rng = np.random.default_rng(1)
    matches = rng.random((20_000, 112)) < 0.8
    kept = np.all([matches[:, : 16 * (i + 1)].sum(1) >= m for i, m in enumerate(needed)], axis=0)
    assert kept.mean() > 0.999


@pytest.fixture(scope="module")
def counter():
    with open(TOKENIZER, encoding="utf-8") as f:
        return tc.Counter(json.load(f))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_token_counts_equal_library(counter, library):
    rnd = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz'’.,!?0123456789 éüñçßАБвгαβΣσ中文字éְ🎉\n\t-_/<|>ENDOFTEXT"
    texts = ["don't I'll we've they're x'stuff !!'s ''s 'S 'll' 'l 'r're 've'd'm ' ''", "a<|endoftext|>b <|startoftext|>", "İstanbul ΣΑΣ Å é",
             "१२३ ٣ ½ ²", "日本語テスト 한국어", "🎉🎉👍🏽", "\x00\x1f x　z\x85w", "", "   ", "a'" * 500, "thththth" * 400, LONG]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 300))) for _ in range(800)]
    assert counter.counts(texts).tolist() == library(texts)


def test_chunk_states_compose(counter):
    rnd = random.Random(2)
    kind = np.array([rnd.randrange(10) for _ in range(5_000)], np.uint8)
    step, _ = tc.splitter()
    state, plain = 0, []
    for k in kind:
        plain.append(state)
        state = step[state, k]
    for chunk in (1, 7, 256, 10_000):
        assert tc.chunk_states(kind, chunk).tolist() == plain


def test_tables_can_be_dropped(counter, library, monkeypatch):
    monkeypatch.setattr(tc, "MAX_STATES", 10)
    monkeypatch.setattr(tc, "MAX_WORDS", 5)
    texts = ["some words to count here", "other words, more tables"] * 3
    assert counter.counts(texts[:2]).tolist() + counter.counts(texts).tolist() == library(texts[:2] + texts)


def test_token_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tc.op7_token_counts(spark, SF).collect()}
    assert got == {d.doc_id: (len(d.text.encode()), n, n > 2048) for d, n in zip(docs, library([d.text for d in docs]))}
    edge = sorted(str(tuple(r)) for r in tc.count_tokens(edge_docs(spark), TOKENIZER).collect())
    assert edge == sorted(str((i, len((t or "").encode()), n, n > 2048)) for (i, t), n in zip(EDGE, library([t or "" for _, t in EDGE])))
    assert tc.count_tokens(edge_docs(spark).limit(0), TOKENIZER).count() == 0
