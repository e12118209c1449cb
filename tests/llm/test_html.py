import random
import re
import time

import pytest
from pyspark.sql import functions as F

from segrisk.llm import html, queries
from segrisk.llm.ranges import with_neighbours

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">One {n}</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies<div>really</div></div><form>Name <input> <button>Go</button></form>
<{tag}><h1>Title &amp; {n}</h1><p>First\n\n  line&nbsp;{n}<br>second {n} <b>bold</b> &eacute;<p class="ad">Buy {n}
<p>Third {n}</{tag}><aside>Side</aside><section id="comments"><p>Nice {n}</p></section>
<div>Same on all</div><footer>&copy; us</footer></body></html>"""


def page(n, tag="article"):
    return PAGE.replace("{n}", str(n)).replace("{tag}", tag)


def test_lines_keep_only_the_article():
    text, _ = html.main_text(page(5), None)
    assert text == "Title & 5 First line 5 second 5 bold é Third 5"


@pytest.mark.parametrize("broken", ["", "plain text", "<p>a<p>b", "<div><p>a</div", "<", "a < b & c", "<article><p>x", "<script>x"])
def test_broken_markup_does_not_fail(broken):
    assert isinstance(html.main_text(broken, [1])[0], str)


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        ("<article><p class='social-history'>a</p><p class='ad-hoc'>b</p><p class=share-price>c</p></article>", "a b c"),
        ("<article>a<div class='ad-slot left'>b</div><p id=socialBar>c</p><div class=header><h1>d</h1></div>e</article>", "a d e"),
        ("<article><p title='the class=ad here'>a</p><p data-class=ad>b<p role=search>c</article>", "a b"),
        ("<section><div class='ad'>x</section><article><p>body text</p></article>", "body text"),
        ("<table><tr><td><div class=ad>x<td>y<tr><td>z</table>after", "y z after"),
        ("<ul><li class=ad>x<li>y</ul><dl><dt class=promo>x<dd>z</dl>", "y z"),
        ("a<span class=ad>x<div>b</div></span>c", "a c"),
        ("<p>a <span class=ad>x</p><p>b</p></span>c", "a b c"),
        ("<head><title>x</title><p>a", "a"),
        ("<div><svg><path><text>x</div>a<noscript><div>x</noscript>b", "a b"),
        ("a<script>var s = \"<a href='\";</script>b<textarea></p><p>x</textarea>c<style>p>a{}</style>d", "a b c d"),
        ("a<script src=x />b</script>c<![CDATA[x]]>d<!-->e<!-- x --!>f<?php x ?>g</>h < i", "abcdefgh < i"),
        ("<div><p>a</div", "a"),
        ("<article>a<article class='comment'>x</article>b</article>", "a b"),
    ],
)
def test_elements_close_as_in_a_browser(markup, text):
    assert html.main_text(markup, None)[0] == text


@pytest.mark.parametrize(
    "part", ["<a ", '<a ">', "<a ='>\" ", "<![CDATA[", "<!-- ", "<b>", "<li>", "<div class=\"", "</", "<p class=ad ", "<section><table><div></section>"]
)
def test_a_long_page_takes_linear_time(part):
    start = time.process_time()
    html.lines_of(part * (1_000_000 // len(part)))
    assert time.process_time() - start < 10


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_is_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 12))] for _ in range(2))
        places = html.common(a, b)
        assert len(places) == longest(a, b) and places == sorted(set(places))
        rest = iter(b)
        assert all(a[i] in rest for i in places)


def test_shared_lines_fall_without_content_element(spark):
    rows = [(i, f"http://h.example/x/{i}", page(i, "div"), "t") for i in range(6)]
    rows += [(9, "http://other.example/x/1", page(9, "div"), "t")]
    rows += [(10, None, None, "t"), (11, "", "", "t"), (0, rows[0][1], rows[0][2], "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    found = [tuple(r) for r in html.extract(pages).collect()]
    assert len(found) == len(rows)
    by_id = {r[0]: r for r in found}
    for i in range(6):
        assert by_id[i][2] == f"Title & {i} First line {i} second {i} bold é Third {i}" and by_id[i][4] > 0
    assert "Same on all" in by_id[9][2] and by_id[9][4] == 0
    assert by_id[10][2:] == ("", 0, 0) and by_id[11][2:] == ("", 0, 0)
    assert html.extract(pages.limit(0)).count() == 0


def test_copies_at_other_addresses_keep_their_text(spark):
    rows = [(i, f"http://h.example/{i}", "<p>The same article text on every address.</p>") for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["text"] for r in html.extract(pages).collect()} == {"The same article text on every address."}


def test_differencing_decides_inside_and_outside_the_content_element(spark):
    def text(i, copied=""):
        return (
            f"<article><h1>Title {i}</h1><p>Long words of the article number {i} and nothing else.<p>Read our letter"
            f"<p>{copied or f'End {i}'}</article><div>Its last part {i}</div><div>Same on all</div><nav>Menu {i}</nav>"
        )

    rows = [(i, f"http://h.example/x/{i}", text(i, "A quote" if i < 2 else "")) for i in range(7)]
    rows += [(i, f"http://few.example/x/{i}", text(i)) for i in (7, 8)] + [(9, "http://one.example/", text(9))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r["page_id"]: (r["text"], r["n_shared"]) for r in html.extract(pages).collect()}
    for i in range(10):
        body = f"Title {i} Long words of the article number {i} and nothing else."
        letter = "" if i < 7 else " Read our letter"
        last = "" if i == 9 else f" Its last part {i}"
        shared = 2 if i < 7 else 1 if i < 9 else 0
        assert found[i] == (f"{body}{letter} {'A quote' if i < 2 else f'End {i}'}{last}", shared), i


def test_pages_that_differ_in_the_query_are_compared(spark):
    text = "<div>Long own words of page {i} and of no other page</div><div>Same on all</div><ul><li>Home<li>About us</ul>"
    rows = [(i, f"http://h.example/index.php?id={i}", text.replace("{i}", str(i))) for i in range(5)]
    rows += [(5, "http://h.example/index.php?id=1&utm_source=x", rows[1][2])]
    rows += [(6, "https://h.example/index.php?id=2&ref=y", rows[2][2] + "<div>x</div>"), (7, None, text), (8, None, text + "9")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    assert len(found) == len(rows)
    for i, page_of in enumerate([0, 1, 2, 3, 4, 1, 2]):
        assert found[i] == f"Long own words of page {page_of} and of no other page" + (" x" if i == 6 else ""), i
    assert "Same on all" in found[7] and "Same on all" in found[8]


def test_copies_keep_their_content_element():
    copy = [html.line_hash(text) for text, _ in html.lines_of(page(5))]
    assert html.main_text(page(5), copy, copy)[0] == html.main_text(page(5), None)[0]


@pytest.mark.parametrize(("n", "depth"), [(0, 3), (2, 3), (5, 4), (40, 3)])
def test_deeper_neighbours_equal_sorted_list(spark, n, depth):
    keys = sorted(f"k{(i * 37) % 101:03d}" for i in range(n))
    rows = spark.createDataFrame([(k, k + "!") for k in keys], "key string, value string").repartition(3)
    side = [None] * depth + [k + "!" for k in keys] + [None] * depth
    got = with_neighbours(rows, "key", "value", depth, rows.select("key")).collect()
    assert sorted(r["key"] for r in got) == keys
    for r in got:
        i = keys.index(r["key"]) + depth
        for k in range(1, depth + 1):
            s = "" if k == 1 else str(k)
            assert (r[f"before{s}"], r[f"after{s}"]) == (side[i - k], side[i + k])


@pytest.mark.parametrize("n", [0, 1, 2, 40])
def test_neighbours_equal_sorted_list(spark, n):
    keys = sorted(f"k{(i * 37) % 101:03d}" for i in range(n))
    rows = spark.createDataFrame([(k, k + "!") for k in keys], "key string, value string").repartition(3)
    got = {r["key"]: (r["before"], r["after"]) for r in with_neighbours(rows, "key", "value").collect()}
    side = [None, *[k + "!" for k in keys], None]
    assert got == {k: (side[i], side[i + 2]) for i, k in enumerate(keys)}


def test_address_forms_agree(spark):
    forms = ["http://H.example/en/7", "https://h.example/en/7/", "http://h.example/en/7.html?x=1", "http://h.example/en/7#top"]
    df = spark.createDataFrame([(u,) for u in forms], "url string")
    assert df.select(html.url_host(F.col("url")), html.url_path(F.col("url"))).distinct().collect() == [("h.example", "/en/7")]


def test_query_gives_the_article_of_every_page(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = queries.op10_html_extraction(spark, sf_dir).collect()
    assert len(found) == len(pages)
    for r in found:
        inner = " ".join(re.findall(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.S))
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|br|h1)>", "\n", inner))
        assert r["text"] == " ".join(html.html.unescape(plain).split()) and r["n_chars"] == len(r["text"])
