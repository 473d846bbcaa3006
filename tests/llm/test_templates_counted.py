"""Template texts of a host are counted over all its distinct pages."""

from prelaunch.llm import html_text as ht


def _pages(n, shared):
    """n distinct pages of one host; the first ``shared`` of them, by id, show the same line under the article's text."""
    body = "<div class='t'>{i} own words {i} of page {i}, long enough to be most of what it shows</div><div class='x'>{x}</div>"
    return [(i, f"http://h.example/{i}", body.format(i=i, x="Read more" if i < shared else f"line {i}")) for i in range(n)]


def _texts(spark, rows):
    return {r.page_id: r.text for r in ht.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}


def test_share_is_of_all_pages_not_of_a_sample(spark):
    # 60 pages of the smallest signatures show one line, 40 do not: a sample of small signatures would call it template
    rows = sorted(_pages(100, 100), key=lambda r: ht.signature(ht.parse(r[2])))
    rows = [(i, u, h if k < 60 else h.replace("Read more", f"line {i}")) for k, (i, u, h) in enumerate(rows)]
    got = _texts(spark, rows)
    assert sum("Read more" in t for t in got.values()) == 60
    assert all("own words" in t for t in got.values())


def test_counted_template_goes(spark):
    got = _texts(spark, _pages(50, 40) + [(1_000 + i, u, h) for i, u, h in _pages(50, 40)])
    assert len(got) == 100 and not any("Read more" in t for t in got.values())
    got = _texts(spark, _pages(50, 39))
    assert sum("Read more" in t for t in got.values()) == 39


def test_hosts_without_pages_text_or_url(spark):
    got = _texts(spark, [(1, None, None), (2, "x", "<p>a"), (3, "http://b/", ""), (4, "http://b/", "<p>c")])
    assert got == {1: "", 2: "a", 3: "", 4: "c"}
