"""Operator 7: alignment against all alignments, pages without marked articles, results
under any partitioning, long and deep pages."""

import random
import time

from contrail.llm import html_wrapper as H
from tests.llm.test_operators import texts_of

SCHEMA = "page_id long, url string, html string, host string, wrapper string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def brute_match(a, b):
    """The most pairs over all order-keeping choices of children."""
    if a[0] != b[0]:
        return 0

    def best(xs, ys):
        if not xs or not ys:
            return 0
        return max(best(xs[1:], ys), *[m + best(xs[1:], ys[j + 1:]) for j, y in enumerate(ys) if (m := brute_match(xs[0], y))] or [0])

    return 1 + best(a[1], b[1])


def test_matching_is_the_best_alignment():
    rng = random.Random(1)

    def tree(depth):
        return [rng.choice("abc"), [tree(depth - 1) for _ in range(rng.randrange(4) if depth else 0)], [], None, [], 0]

    for _ in range(300):
        a, b = tree(3), tree(3)
        a[0] = b[0] = "r"
        assert H.match(a, b, {}) == brute_match(a, b)
        pairs = H.aligned(a, b, {})
        assert 1 + sum(brute_match(a[1][i], b[1][j]) for i, j in pairs) == brute_match(a, b)


def _site(i):
    """A host without article or main: three layouts, words of the site around the text."""
    extra = {0: "", 1: "<div id=gallery><img src=x><p>pictures of {0}</p></div>", 2: "<table><tr><td>row {0}<td>two</table>"}[i % 3]
    return (f"<body><div id=brand>House of pages</div><div id=page><h1>Head {i}</h1><p>text of page {i} in words</p>" + extra.format(i)
            + "<p>Sign up for our weekly letter!</p></div><div id=end>Imprint and terms</div></body>")


def test_partitions_do_not_matter(spark):
    rows = [(i, f"https://Site.example/{i}", _site(i)) for i in range(40)] + [(100 + i, "http://other.example/", _site(3)) for i in range(5)] + [(None, None, None)]
    results = [sorted(map(tuple, H.main_text(frame(spark, rs).repartition(n)).collect()), key=str) for rs, n in ((rows, 1), (rows[::-1], 7))]
    assert results[0] == results[1]
    text = {r[0]: r[2] for r in results[0]}
    for i in range(40):
        tail = {0: "", 1: f"\npictures of {i}", 2: f"\nrow {i}\ntwo"}[i % 3]
        assert text[i] == f"Head {i}\ntext of page {i} in words" + tail
    # five copies of one page are one page: nothing is constant on different pages
    assert text[100] == "House of pages\nHead 3\ntext of page 3 in words\nSign up for our weekly letter!\nImprint and terms"
    assert text[None] == ""


def test_constant_lines_of_articles_are_template():
    page = "<body><article><h1>Head {0}</h1><p>long text of {0}</p><p>Sign up for our weekly letter!</p><p>more of {0}</p></article></body>"
    assert texts_of([page.format(i) for i in range(5)]) == [f"Head {i}\nlong text of {i}\nmore of {i}" for i in range(5)]
    assert texts_of([page.format(i) for i in range(2)])[0] == "Head 0\nlong text of 0\nSign up for our weekly letter!\nmore of 0"


def test_title_in_the_header_of_an_article():
    page = "<body><header><h1>Site</h1></header><article><header><h1>Head {0}</h1><p>by somebody {0}</p></header><p>text {0}</p><footer><h1>x{0}</h1></footer></article></body>"
    assert texts_of([page.format(i) for i in range(4)]) == [f"Head {i}\ntext {i}" for i in range(4)]


def test_the_host_decides_about_articles():
    page = "<body><div>aside of {0} with a few words</div><article><p>{1}</p></article></body>"
    sources = [page.format(i, f"the long text of page {i} " * 10) for i in range(4)] + [page.format(9, "short")]
    assert texts_of(sources)[-1] == "short"


def test_roles_below_the_deepest_node():
    for depth in (10, H.MAX_DEPTH + 10):
        page = "<div>" * depth + "<p>text {0}</p><nav>menu {0}</nav><div class=comments>said {0}</div><p>end {0}</p>" + "</div>" * depth
        assert texts_of([page.format(i) for i in range(4)]) == [f"text {i}\nend {i}" for i in range(4)]


def test_long_pages_take_time_in_proportion(spark):
    sources = ["<div>" * 200_000 + "end", "<p>x<b>" * 100_000, "<ul>" + "<li>item" * 100_000, "<i>" * 100_000 + "</b>" * 100_000 + "t", "<" * 300_000, "&amp;" * 200_000, "<a b='" * 50_000, "<a b='" * 50_001 + ">", "<a b=\"'" * 50_000 + ">t", "x <!-- y" * 50_000]
    for source in sources:
        begin = time.time()
        H.Page(source)
        assert time.time() - begin < 15, source[:20]
    got = H.main_text(frame(spark, [(i, "http://long.example/", s) for i, s in enumerate(sources[:3])])).collect()
    assert {r.page_id: r.n_chars for r in got}[0] == 3
