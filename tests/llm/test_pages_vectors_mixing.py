"""HTML extraction, URL reputation, top-k search and mixing."""

import re
from html import unescape

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from prelaunch.llm import html_text as ht
from prelaunch.llm import mixing as mx
from prelaunch.llm import topk_search as tk
from prelaunch.llm import url_reputation as ur

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    return con


def same_rows(spark_df, duck_df):
    key = lambda rows: sorted(map(repr, rows))
    a = spark_df.toPandas()
    return key(a.itertuples(index=False, name=None)) == key(duck_df[list(a.columns)].itertuples(index=False, name=None))


PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li>a<li>b</ul></nav>'
        '<main><div><h2>A &amp; B</h2><p>one<br>two <b>x</b><p>three&nbsp; four</div><table><tr><td>c1<td>c2</table><aside>no</aside><form>f</form>'
        '<div class="cookie-notice">n</div><div class="comments"><p>c</p></div><ul><li>i1<li>i2</ul><dl><dt>t<dd>d<dt>t2<dd>d2</dl>'
        '<script>var x = "</p><p>no";</script><!-- <p>no</p> --></main><footer>x</footer>')
MAIN = "A & B\none two x\nthree four\nc1\nc2\ni1\ni2\nt\nd\nt2\nd2"


def one_page(page, wrapper=None):
    w = ht.infer(wrapper, page)
    return ht.extract(ht.mark(w), page)


def test_extract_one_page():
    assert one_page(PAGE) == MAIN
    for broken in ("", "<", "<a", '<p class="x', "<script>", "</p></p>", "<!-- x", "<" * 500, "<div>" * 3_000 + "x"):
        assert isinstance(one_page(broken), str)
    assert one_page("<div>" * 3_000 + "x") == "x" and one_page("a<p>b") == "a\nb"


def test_wrapper_generalises():
    first = "<article><h1>T</h1><p>a</p><p>b</p></article><footer>same</footer>"
    second = "<article><h1>U</h1><h2>s</h2><p>c</p></article><footer>same</footer>"
    w = ht.infer(ht.infer(None, first), second)
    article, footer = w
    assert [(x[0], x[1]) for x in article[3]] == [("h1", "1"), ("h2", "?"), ("p", "+")]
    assert article[3][0][3][0][2] is None and footer[3][0][2] is not None      # a slot and a constant
    shape = lambda items: [(l, q, v is None, shape(c)) for l, q, v, c in items]
    assert shape(ht.infer(w, first)) == shape(ht.infer(w, second)) == shape(w)  # nothing new to learn
    groups = ht.infer(None, "<dl><dt>1<dd>2<dt>3<dd>4</dl>")
    assert groups[0][3][0][:2] == ["()", "+"]


def test_host_without_article_keeps_what_differs():
    pages = [f"<div class='top'>Welcome</div><div class='body'>text {i}</div><div class='end'>All rights</div>" for i in range(3)]
    w = None
    for p in pages:
        w = ht.infer(w, p)
    assert [ht.extract(ht.mark(w), p) for p in pages] == ["text 0", "text 1", "text 2"]


def wrapped(pages):
    w = None
    for p in pages:
        w = ht.infer(w, p)
    m = ht.mark(w)
    return [ht.extract(m, p) for p in pages]


def words(i, n=30):
    return " ".join(f"w{i * 31 + j}" for j in range(n))


def test_template_goes_without_telling_names():
    """No article element, no class: what nearly all distinct pages show at a place is the template, copies of a page count once."""
    page = lambda i, body: f"<div><div>Daily News</div><ul><li>Home<li>World<li>Sport</ul></div><div><div>{body}</div></div><div>Subscribe now for more</div>"
    bodies = [f"<p>{words(2 * i)}</p><p>{words(2 * i + 1)}</p>" for i in range(6)]
    texts = [f"{words(2 * i)}\n{words(2 * i + 1)}" for i in range(6)]
    assert wrapped([page(i, b) for i, b in enumerate(bodies)]) == texts
    copies = [page(0, bodies[0])] * 8 + [page(i, b) for i, b in enumerate(bodies)]
    assert wrapped(copies) == [texts[0]] * 8 + texts
    # a block that two pages share and others lack stays
    quoted = [page(i, b + ("<blockquote>the shared quotation</blockquote>" if i < 2 else "")) for i, b in enumerate(bodies)]
    assert wrapped(quoted) == [t + ("\nthe shared quotation" if i < 2 else "") for i, t in enumerate(texts)]
    # inside an article, too
    calls = [f"<article><h1>T{i}</h1><div>{words(i)}</div><div><div>Read more on our site</div></div></article>" for i in range(5)]
    assert wrapped(calls) == [f"T{i}\n{words(i)}" for i in range(5)]


def test_copies_of_one_article_keep_it():
    pages = [f"<div>{words(0)}</div><div>views {i}</div>" for i in range(3)]
    assert wrapped(pages) == [f"{words(0)}\nviews {i}" for i in range(3)]


def test_names_are_a_prior():
    assert one_page(f"<div class='layout no-sidebar'><article><p>{words(1)}</p></article></div>") == words(1)
    assert one_page(f"<div class='content-sidebar-wrap'><main><p>{words(1)}</p></main><div class='sidebar'>no</div></div>") == words(1)
    kept = "<article><p>a</p><div class='side-effects'>nausea</div><p class='share-price'>3 up</p><div class='ad-banner'>buy</div><aside>no</aside></article>"
    assert one_page(kept) == "a\nnausea\n3 up"
    deep = "<article><p>first</p>" + "<div>" * 400 + "x" + "</div>" * 400 + "<p>last</p></article><div>no</div>"
    assert one_page(deep) == "first\nx\nlast"


def test_alignment_is_a_longest_common_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (["abcd"[i] for i in rng.integers(0, 4, rng.integers(0, 12))] for _ in range(2))
        got = ht.pairs([[x, "1", None, []] for x in a], [[x, "1", None, []] for x in b])
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        assert len(got) == best[-1][-1] and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_wide_pages_in_seconds():
    import time
    rng = np.random.default_rng(1)
    wide = ["<body>" + "".join(f"<{t}>t{i}.{k}</{t}>" for i, t in enumerate(rng.choice(["p", "h2", "pre", "section", "figure"], 20_000))) for k in range(2)]
    start = time.time()
    got = wrapped(wide)
    assert time.time() - start < 30 and [len(t.split("\n")) for t in got] == [20_000] * 2


def test_html_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in ht.op5_html_extraction(spark, SF).collect()}
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S).group(1)
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(b for b in blocks if b)
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (text, len(text), p.url)


def test_html_edge_cases(spark):
    rows = [(1, "http://a.b/x", None, "z"), (2, None, "", "z"), (3, "no url", PAGE, "z"), (3, "no url", PAGE, "z"), (None, "http://A.b/y", "<p>" + "x " * 50_000, "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(str((r.page_id, r.n_chars)) for r in ht.extract_text(pages).collect())
    assert got == sorted(map(str, [(1, 0), (2, 0), (3, len(MAIN)), (3, len(MAIN)), (None, 99_999)]))
    assert ht.extract_text(pages.limit(0)).count() == 0


def test_url_query_equals_sql(spark, duck):
    assert same_rows(ur.op2_url_filter(spark, SF), duck.sql(ur.ORACLE_SQL).df())


def test_url_rules_and_edge_cases(spark):
    urls = ["http://www.Example.com/en/1?q", "https://sub.example.com/en/", "http://example.com/fr#x", "http://notexample.com.org/en/", "http://x.net/es",
            "http://x.net/es/a", "http://x.net", None, "no url", "http://x.net/es/a", "ftp://a://b/c", "http://" + "a" * 10_000 + ".net/fr/"]
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in ur.judge_urls(pages, ur.QUERY_RULES).collect()}
    assert [(got[i].rule, got[i].verdict) for i in (0, 1, 2)] == [("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("com/", "allow")]
    assert got[0].host == "www.example.com" and got[0].path == "/en/1"
    assert got[3].rule is None and got[4].rule is None and got[5].rule == "net/es/" and got[6].path == ""
    assert [(got[i].host, got[i].path, got[i].rule) for i in (7, 8)] == [("", "", None)] * 2
    assert got[10].host == "a:" and got[11].rule == "net/fr/"
    assert ur.judge_urls(pages.limit(0), ur.QUERY_RULES).count() == 0
    assert {r.verdict for r in ur.judge_urls(pages, []).collect()} == {"allow"}


def test_reputation_shrinks(spark):
    rows = [(f"h{i}.bad.org", 20, 20) for i in range(10)] + [(f"h{i}.good.net", 20, 0) for i in range(10)] + [("new.bad.org", 0, 0), ("one.good.net", 1, 1)]
    got = {r.host: r for r in ur.host_reputation(spark.createDataFrame(rows, "host string, n long, y long")).collect()}
    assert got["h1.bad.org"].bound > 0.75 and got["h1.good.net"].mean < 0.2
    assert got["new.bad.org"].mean > 0.7                         # from its domain
    assert got["one.good.net"].bound < 0.5                       # one outcome does not outweigh the domain


def test_topk_query_equals_sql(spark, duck):
    assert same_rows(tk.op3_topk(spark, SF), duck.sql(tk.ORACLE_SQL).df())


def test_search_block_is_exact_and_stops_early():
    rng = np.random.default_rng(4)
    x = rng.integers(-60, 60, (900, 8))
    x[100:140] = x[100]                                           # ties
    ids = rng.permutation(900)
    q = np.concatenate([rng.integers(-60, 60, (20, 8)), [x[100] * 5], [np.zeros(8, int)]])
    qids = np.concatenate([ids[:20], [-1, -2]])
    lists = tk.SortedLists(ids, x)
    which, vec, score, depth = tk.search_block(lists, qids, q, 5)
    for i in range(len(q)):
        s = x @ q[i]
        best = sorted((-int(s[j]), int(ids[j])) for j in range(900) if ids[j] != qids[i])[:5]
        assert [(-int(b), int(a)) for a, b in zip(vec[which == i], score[which == i])] == best
    assert depth[20] < 900                                        # a clear winner ends the reading early


def test_topk_edge_cases(spark):
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [1.0]), (50, [0.25, -1.0]), (50, [0.25, -1.0]),
            (None, [1.0, 1.0]), (6, [float("inf"), 0.0]), (7, [1e9, 0.0]), (8, [1.0, 0.5])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in tk.search(df.where("vec_id % 50 = 0"), df).collect())
    a, b, big = 256 * 256 + 128 * 128, 256 * 64 - 128 * 256, 256 * 10 ** 9
    assert got == sorted([(0, 1, 7, big * 256), (0, 2, 1, a), (0, 3, 8, a), (0, 4, 50, b), (0, 5, 50, b)]
                         + [(50, k + 1, v, s) for k, (v, s) in enumerate([(7, big * 64), (0, b), (1, b), (8, b)])] * 2)
    assert tk.search(df.limit(0), df).count() == 0
    small = sorted(tuple(r) for r in tk.search(df.where("vec_id % 50 = 0"), df, block=2, query_block=1, broadcast_bytes=24).collect())
    assert small == got


def test_topk_keeps_every_finite_vector(spark, duck):
    """Large components as query and candidate, against integers of any size; only a returned score beyond a long is an error."""
    rows = [(0, [3e5, 1.0]), (1, [3e5, 1.0]), (2, [-7e6, 2.0]), (3, [1e8, -1e8]), (4, [0.5, 0.25]), (50, [0.0, 2.0 ** 40]), (100, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = {}
    for i, v in rows:
        if i % 50 == 0:
            scored = sorted((-sum(tk.whole(x) * tk.whole(y) for x, y in zip(v, w)), j) for j, w in rows if j != i)[:5]
            exact.update({(i, r + 1): (j, -s) for r, (s, j) in enumerate(scored)})
    kept = {k: v for k, v in exact.items() if k[0] != 50}
    got = tk.search(df.where("vec_id in (0, 100)"), df)
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got.collect()} == kept and all(abs(s) < 1 << 63 for _, s in kept.values())
    far = spark.createDataFrame([(0, [1e300]), (1, [1e300]), (2, [0.0]), (3, [-1e308])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exceeds a long"):
        tk.search(far.where("vec_id = 0"), far).collect()
    assert [(r.vec_id, r.score) for r in tk.search(far.where("vec_id = 2"), far).orderBy("rank").collect()] == [(0, 0), (1, 0), (3, 0)]
    import duckdb
    con = duckdb.connect()
    con.sql("create table embeddings (vec_id bigint, embedding double[])")
    con.executemany("insert into embeddings values (?, ?)", [r for r in rows if r[0] != 50 and r[0] != 3])
    some = df.where("vec_id not in (3, 50)")
    assert same_rows(tk.search(some.where("vec_id % 50 = 0"), some), con.sql(tk.ORACLE_SQL).df())


def test_topk_bounds_read_lists_in_stretches():
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(700, 3)) * 256 * np.array([9, 1, 1])).astype(np.int64)
    q = np.floor(rng.normal(size=(40, 3)) * 256).astype(np.int64)
    lists = tk.SortedLists(np.arange(700), x)
    for _ in range(2):
        which, vec, score, depths = tk.search_block(lists, np.full(40, -1), q, 5, few=5)
        scores = x @ q.T
        for c in range(40):
            want = np.lexsort((np.arange(700), -scores[:, c]))[:5]
            assert vec[which == c].tolist() == want.tolist() and score[which == c].tolist() == scores[want, c].tolist()
    assert depths.min() < 700


def test_mixing_query_equals_sql_and_brute_force(spark, duck):
    got = mx.op6_mixing(spark, SF)
    assert same_rows(got, duck.sql(mx.ORACLE_SQL).df())
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((r.doc_id, r.copy) for r in got.collect()) == sorted(mx.brute_force(docs))


def test_poisson_inverse_has_its_distribution(spark):
    for mean in (0.3, 2.5, 40.0):
        n = spark.range(4_000).select(mx.repetitions(F.lit(mean), F.concat(F.lit("d"), F.col("id").cast("string"))).alias("n")).agg(
            F.avg("n").alias("m"), F.var_pop("n").alias("v")).first()
        assert abs(n.m - mean) < 5 * (mean / 4_000) ** 0.5 and abs(n.v - mean) < 0.15 * mean


def test_mixing_edge_cases(spark):
    rows = [(1, "a" * 10, "s"), (1, "a" * 10, "s"), (2, None, "s"), (3, "", None), (None, "bb", None), (4, "c" * 100_000, "big"), (5, "", "void")]
    docs = spark.createDataFrame([(*r, 9, 1.0) for r in rows], "doc_id long, text string, source string, copy int, shuffle_key double")
    got = mx.mix(docs)
    assert got.columns == ["doc_id", "text", "source", "copy", "shuffle_key", "mix_copy", "mix_shuffle_key"]
    out = got.collect()
    assert sorted(str((r.doc_id, r.mix_copy)) for r in out) == sorted(map(str, mx.brute_force(rows)))
    assert [r.mix_shuffle_key for r in out] == sorted(r.mix_shuffle_key for r in out)     # globally shuffled by key
    assert not any(r.source == "void" for r in out)
    only = mx.mix(docs.select("doc_id", "text", "source"), weights={"s": 2.0, None: 0.0}, budget=400.0).collect()
    assert {r.source for r in only} == {"s"}
    assert mx.mix(docs.limit(0)).count() == 0
