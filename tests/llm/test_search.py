"""URL filter, components, vector search, HTML extraction."""

import itertools
import math
import random

import pyarrow as pa
import pytest

from sectorloom.llm import html_extract, url_filter, va_file
from sectorloom.llm.components import components


@pytest.mark.parametrize("shape", ["none", "chain", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(4)
    edges = {
        "none": [],
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(7, i) for i in range(60)] + [(7, 7), (None, 3), (7, 8)],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(50)],
    }[shape]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert got == {x: find(x) for x in parent}


def page(url, links=""):
    return (url, f"<html><head>{links}</head><body>x</body></html>")


def test_urls(spark):
    canonical = '<link rel="canonical" href="{}">'.format
    refresh = '<META http-equiv=refresh content="0; url={}">'.format
    rows = [
        page("https://A.Example.ORG/es/1"),
        page("http://example.org/en/1?x"),
        page("http://www.b.com/de/a", canonical("http://other.net/x?a=1&amp;b=2")),
        page("http://other.net/x?a=1&b=2#top"),
        page("http://third.net/y", refresh("//other.net/x?a=1&b=2")),
        page("http://fourth.net/fr/", canonical("http://c.com/fr/ok")),
        page("http://fifth.net/q", canonical("http://fourth.net/fr/")),
        page("http://fifth.net/z", refresh("http://d.com/de/") + canonical("/q")),
        page("http://none.net"),
        page("no scheme"),
        (None, None),
        page("http://notexample.org/es/"),
        page("://org"),
        page("http://none.net"),
    ]
    pages = spark.createDataFrame(
        [(i, *r, "x") for i, r in enumerate(rows)], "page_id int, url string, html string, verdict string"
    )
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert len(got) == len(rows)
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/1", "example.org/en/1", "block")
    assert got[2] == ("www.b.com", "/de/a", "com/de/", "block")
    assert got[3] == ("other.net", "/x", None, "block")
    assert got[4] == ("third.net", "/y", None, "block")
    assert got[5] == ("fourth.net", "/fr/", None, "allow")
    assert got[6] == ("fifth.net", "/q", None, "allow")
    assert got[7] == ("fifth.net", "/z", None, "allow"), "an allow rule outranks a block rule of an alias"
    assert got[8] == got[13] == ("none.net", "", None, "allow")
    assert got[9] == got[10] == ("", "", None, "allow")
    assert got[11] == ("notexample.org", "/es/", "org/", "allow")
    assert got[12] == ("org", "", None, "allow")
    assert url_filter.judge(pages.where("false")).collect() == []
    assert {r.verdict for r in url_filter.judge(pages, []).collect()} == {"allow"}
    moved = spark.createDataFrame([("http://none.net", "http://x.com/de/1")], "url string, target string")
    by_id = {r.page_id: r.verdict for r in url_filter.judge(pages, redirects=moved).collect()}
    assert by_id[8] == "block"


def brute_top(rows, k=5, step=50):
    good = []
    for vec_id, vec in rows:
        if vec_id is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec):
            good.append((vec_id, tuple(math.floor(256 * x) for x in vec)))
    out = []
    for q, vec in dict.fromkeys(good):
        if q % step:
            continue
        scored = [(-sum(a * b for a, b in zip(vec, v)), i) for i, v in good if i != q and len(v) == len(vec)]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("chunk_rows", [7, 100])
def test_vectors(spark, chunk_rows):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(150)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)] + [rows[3], *[rows[7]] * 3, *[rows[8]] * 30, rows[100], (2000, [0.5] * 3), (2050, [1.0, -2.0, 300.0])]
    rows += [(3000, None), (3050, [None] * 6), (3100, [float("nan")] * 6), (3150, [float("inf")] * 6), (None, [0.1] * 6)]
    rows += [(4000, []), (4050, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, rank int")
    got = sorted(map(tuple, va_file.top_k(df, chunk_rows=chunk_rows, block_queries=3).collect()))
    assert got == brute_top(rows)
    assert va_file.top_k(df.where("false")).collect() == []


@pytest.mark.parametrize("pass_bytes", [None, 20_000])
def test_no_pair_of_chunk_and_query_is_broadcast(spark, monkeypatch, pass_bytes):
    rng = random.Random(6)
    rows = [(50 * i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(300)]
    rows += [rows[3], (rows[4][0], rows[5][1]), (7, rows[6][1]), (100, [0.5] * 3), (8, [1.0] * 3), (150, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    sent, broadcast = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: sent.append(value) or broadcast(value))
    spark.conf.set("spark.sql.maxBroadcastTableSize", "100k")  # any broadcast join takes more
    try:
        more = {"pass_bytes": pass_bytes} if pass_bytes else {}
        got = sorted(map(tuple, va_file.top_k(df, chunk_rows=7, block_queries=3, **more).collect()))
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    nearest = {}  # the vectors of one id are one query
    for query, _, vec_id, score in brute_top(rows):
        nearest.setdefault(query, []).append((-score, vec_id))
    assert got == [(q, n, i, -s) for q in nearest for n, (s, i) in enumerate(sorted(nearest[q])[:5], 1)]
    queries = [x for x in sent if all(isinstance(y, tuple) for y in x)]
    assert len(queries) == (3 if pass_bytes else 1)
    assert all(sum(len(ids) + len(exact) for _, ids, exact in x) < 10_000 for x in queries)


def test_scores_that_wrap(spark):
    rng = random.Random(7)
    rows = [(i * 10, [rng.uniform(-1e15, 1e15) for _ in range(4)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    wrapped = lambda x: (x + (1 << 63)) % (1 << 64) - (1 << 63)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    expected = []
    for q, vec in whole[::5]:
        scored = sorted((-wrapped(sum(a * b for a, b in zip(vec, v))), i) for i, v in whole if i != q)
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)]
    assert sorted(map(tuple, va_file.top_k(df, chunk_rows=7, block_queries=3).collect())) == expected


def test_bounds_let_the_search_stop(monkeypatch):
    import numpy as np

    read = []
    exact = np.arange(400).reshape(400, 1)
    monkeypatch.setattr(va_file, "_SLAB", 10)

    class Counted(np.ndarray):
        def __getitem__(self, item):
            read.append(len(item))
            return np.asarray(super().__getitem__(item))

    ids, scores = va_file._search(np.array([2]), exact.view(Counted), exact[:, 0] * 2 + 3, np.arange(400), np.arange(400), 5)
    assert ids.tolist() == [399, 398, 397, 396, 395] and scores[0] == 798
    assert sum(read) < 40


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body><header>Site name</header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="ad">Buy this now</div><aside>Side note</aside><div class="cookie-notice">We use cookies</div>
<article><h1>Head &amp; line</h1><p><b>First para<br>still   first.<p>Sec&eacute;ond <a href=x>with a link</a> &lt;tag&gt;</p>
<!-- hidden <p>comment</p> --><form>Your name <input></form><p>Z.</p>
<section class="comments"><p>Reader says a lot of words here, none of them part of the article itself.</p></section>
</article><footer>&copy; me</footer></body></html>"""


def test_main_text(spark):
    expected = "Head & line First para still first. Secéond with a link <tag> Z."
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "just text " * 30), (5, "u", PAGE), (6, "u", "<p")]
    rows.append((7, "u", "<article>" + "<p>word " * 40_000))
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id int, url string, html string, text string")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in html_extract.extract(pages).collect()}
    assert got[1] == got[5] == ("u", expected, len(expected))
    assert got[2] == ("u", "", 0) and got[3] == (None, "", 0)
    assert got[4][1] == ("just text " * 30).strip()
    assert got[7][1] == " ".join(["word"] * 40_000)
    assert html_extract.extract(pages.where("false")).collect() == []


def test_page_without_article_keeps_prose_and_drops_links():
    prose = "a sentence of some length that goes on for quite a while, as prose does. " * 4
    text = f"<div><a>Home</a> <a>News</a></div><div><p>{prose}</p><p>{prose}</p></div><div><a>About us</a></div>"
    assert html_extract.main_text(text) == " ".join(f"{prose}{prose}".split())


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<article><p title=it's>hello there</article>", "hello there"),
        ("<article><p title='a > b' x=\"c > d\" e=f\"g>hello</p> <a href=a'b>link</a></article>", "hello link"),
        ("<article><p class=\"ad\">buy<p>text</article>", "text"),
        ("<article><ul><li class=advert>buy<li>one<li class='share-buttons'>x</li></ul><p>end</article>", "one end"),
        ("<article><table><tr><td class=sidebar>no<div>nor this</div><td>yes<tr class=promo><td>no<tr><td>end</table>after</article>", "yes end after"),
        ("<article><div class=social-science>kept</div><div class=social-links>not</div></article>", "kept"),
        ("<article><div class='cookie-notice'>no</div><div class=header-image>a caption</div><div id=sidebar_left>no</div></article>", "a caption"),
        ("<article><dl><dt class=ads>no<dd>yes</dl><p class=comments>no<div>yes too</div></article>", "yes yes too"),
        ("<table><tr><td class=menu>Menu<td class='related main'><article>whole text</article></table>", "whole text"),
        ("<article><ul><li class=ad>no<ul><li>nor this</ul>nor that<li>yes</ul></article>", "yes"),
    ],
)
def test_attributes_and_named_items(html, expected):
    assert html_extract.main_text(html) == expected


def test_a_tag_that_never_ends_is_read_in_linear_time():
    for text in ("<p " + "a=b " * 100_000, "<p " + "a" * 400_000, "<p x='" + "a " * 200_000, "<" * 100_000):
        html_extract.main_text(f"<article>before {text}")


def test_tree_learns_its_table():
    root = html_extract.tree()
    for row in html_extract.LABELLED:
        assert html_extract.answer(root, row[:-1]) == bool(row[-1])


def test_batches_of_any_size_are_cut_at_rows():
    from sectorloom.llm.common import slices

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (0, 5, 900, 1, 2000, 3)] + [None])], ["text"])
    parts = [p.num_rows for p in slices(batch, "text", 500)]
    assert sum(parts) == 7 and list(itertools.accumulate(parts))[-1] == 7


@pytest.mark.parametrize("open_", ["<svg class=i/>", "<math x='1'/>", "<svg>", "<iframe src=a>", "<object>", "<svg><svg></svg>", "<script src=a />", "<SELECT>", "<title-bar>"])
def test_unread_elements_without_end_swallow_nothing(open_):
    body = f"<article><p>real text</p>{open_}<p>more of it</p><svg><text>no</text></svg> end</article>"
    assert html_extract.main_text(f"<html><head><title>t</title><body>{body}") == "real text more of it end"
    assert html_extract.main_text(f"<html><body>{body}</body></html>") == "real text more of it end"


def test_unread_elements_are_left_out():
    inside = "<svg><svg>a</svg>b<!-- </svg> --></svg><noscript>c</noscript><Select><option>d</select ><script>'<svg>'</script>"
    assert html_extract.main_text(f"<article><p>x {inside} y</p><style>p") == "x y"
    many = "<object>" * 20_000
    assert html_extract.main_text(f"<article>x {many} y</article>") == "x y"


@pytest.mark.parametrize(
    "open_, close",
    [
        ("<div class='layout with-sidebar'>", "</div>"),
        ("<div id=page class='site has-header-image'>", "</div>"),
        ("<form id=f>", "</form>"),
        ("<div class='sidebar-left'><form>", "</form></div>"),
    ],
)
@pytest.mark.parametrize("name", ["article", "main"])
def test_article_in_a_wrapper_named_like_furniture(open_, close, name):
    inside = "<p>real text</p><div class='ad'>buy</div><section class=comments><article>says</article></section><p>ends</p>"
    page = f"<body>{open_}<nav>menu</nav><{name}>{inside}</{name}><aside><article>teaser</article></aside>{close}</body>"
    assert html_extract.main_text(page) == "real text ends"


def test_layout_modifiers_are_no_furniture():
    prose = ("a sentence of some length that goes on for quite a while, as prose does. " * 4).strip()
    page = "<div class='layout {}'><p>" + prose + "</p></div><div class='site-footer'><p>" + prose + "</p></div>"
    for name in ("with-sidebar", "has-header-image", "no_menu"):
        assert html_extract.main_text(page.format(name)) == prose
    assert html_extract.main_text(page.format("side-bar")) == ""
