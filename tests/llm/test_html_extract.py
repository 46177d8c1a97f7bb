from __future__ import annotations

import html
import re

import cases
import numpy as np
import pytest

from tagloom.llm import html_extract
from tagloom.llm.dom import Page, features
from tagloom.llm.trees import boost

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def forest():
    return html_extract.trained(150)


def words_kept(page, forest):
    return page.text(html_extract.decode(page, forest.logits(features(page)))).split()


def test_held_out_pages(forest):
    wrong = total = 0
    for source in html_extract.training_pages(80, seed=500):
        page = Page(source)
        article = [w for w in page.text(page.shown()).split() if "q" in w]
        kept = words_kept(page, forest)
        good = [w for w in kept if "q" in w]
        wrong += len(article) - len(good) + len(kept) - len(good)
        total += len(article)
    assert wrong < 0.06 * total


def test_decoding_is_the_best_of_all_consistent_choices():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = 9
        page = Page("")
        for i in range(1, n):
            page._add("div", "", int(rng.integers(0, i)))
        logits = rng.normal(size=n)
        best = max(
            sum(logits[i] for i in range(1, n) if choice >> i & 1)
            for choice in range(1, 1 << n, 2)
            if all(choice >> page.parents[i] & 1 for i in range(1, n) if choice >> i & 1)
        )
        kept = html_extract.decode(page, logits)
        assert all(kept[page.parents[i]] for i in range(1, n) if kept[i])
        assert sum(logits[1:][kept[1:]]) == pytest.approx(best)


def whole(source):
    page = Page(source)
    return page.text(page.shown())


@pytest.mark.parametrize(
    "source, text",
    [
        ("<p>a<p>b</p>c", "a b c"),
        ("<p>a<b>b</b>c <i>d</i>", "abc d"),
        ("<p>a<br>b", "a b"),
        ("x<br/>y<hr>z", "x y z"),
        ("<ul><li>a<li>b</ul>c", "a b c"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<script>var t='</p>';</script><p>&lt;a&gt; &amp;amp; &#233;&nbsp;x &am", "<a> &amp; é x &am"),
        ("<style>p{}</style><!-- <p>no</p> --><p title='>'>yes", "yes"),
        ("a < b and 3<4", "a < b and 3<4"),
        ("<p hidden>a</p><noscript><p>b</p></noscript><p>x<math><mi>c</mi></math></p>", "a b x c"),
        ("wor<script>x</script>ld <b>o<style>y</style>ne</b>", "world one"),
        ("a<select><option>b</select>c<div>d</div>e", "ac d e"),
        ("<p>end <p cla", "end"),
        ("<p>a\n\t b</p>\n<p>  c</p>", "a b c"),
        ("<div>a<p>b</div>c", "a b c"),
        ("", ""),
        (None, ""),
        ("<title>t</title>", ""),
        ("<script>never closed <p>x", ""),
    ],
)
def test_text_of_markup(source, text):
    assert whole(source) == text


def test_deep_pages_and_long_pages(forest):
    deep = "<div>" * 5_000 + "x" + "</div>" * 5_000
    assert html_extract.main_text(deep, forest) in ("", "x")
    long = "<article><h1>T</h1>" + "<p>some words of the text, and more.</p>" * 20_000 + "</article>"
    assert html_extract.main_text(long, forest).count("some") == 20_000


def test_pages_of_the_test_tables(spark, forest):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_extract.extract(pages, forest).collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", sources[r["page_id"]], re.S)[1]
        body = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", body))
        assert r["text"] == " ".join(html.unescape(body).split())
        assert r["n_chars"] == len(r["text"])


def test_awkward_rows(spark, forest):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>Some words of an article.</p></article>"), (2, None, "")]
    df = cases.clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted(html_extract.extract(df, forest).collect(), key=str)
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in got] == [
        (1, "", 0), (2, "", 0), (2, "", 0), (None, "Some words of an article.", 25),
    ]
    assert html_extract.extract(df.limit(0), forest).count() == 0


def test_trees_learn_a_rule():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2_000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    forest = boost(x[:1_500], y[:1_500], trees=20)
    assert ((forest.logits(x[1_500:]) > 0) == (y[1_500:] > 0)).mean() > 0.95
    flat = boost(np.ones((10, 2)), np.ones(10), trees=2)
    assert (flat.logits(np.zeros((3, 2))) > 0).all()
