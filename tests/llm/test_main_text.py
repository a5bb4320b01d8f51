import html
import re

import numpy as np
import pytest

from lodgegrid.llm.main_text import (
    LABELLED, blocks_of, features, grow, kept, main_blocks, main_texts, op13_main_text, trained)

from .conftest import FOLDER

TREE = trained()


def text_of(page):
    return " ".join(main_blocks(page, TREE))


LONG = "A long paragraph with many plain words in it that no menu would ever have, and then some more of them."


def test_whole_table_against_the_article_element(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    expected = {}
    for r in pages:
        own = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        own = re.sub(r"<(?!/?b>)[^>]*>", " ", own).replace("<b>", "").replace("</b>", "")
        text = " ".join(html.unescape(own).split())
        expected[r.page_id] = (r.url, text, len(text))
    found = {r.page_id: (r.url, r.text, r.n_chars) for r in op13_main_text(spark, FOLDER).collect()}
    assert found == expected


def test_article_without_what_is_around_it():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
    <header><h2>Site name</h2></header><nav><a href=/>Home</a> <a href=/b>News</a></nav>
    <div class="cookie-notice"><p>{LONG}</p></div>
    <article><header><h1>Headline</h1></header><p>{LONG}</p><div class="adBox">Buy this now, {LONG}</div>
    <p>Yes.</p><form><p>Your mail, please: {LONG}</p><select><option>one</select></form>
    <p><a href=x>A linked sentence is kept.</a></p><footer>Filed under things</footer>
    <section id="comments"><p>{LONG}</p></section></article>
    <aside><p>{LONG}</p></aside><div><p>{LONG}</p></div><footer>&copy; us</footer></body></html>"""
    assert text_of(page) == f"Headline {LONG} Yes. A linked sentence is kept."


def test_page_that_marks_no_article():
    page = f"""<div><a href=/>Home</a></div><div><a href=/a>About us</a></div><h1>The headline of it</h1>
    <p>{LONG}</p><p>Short one.</p><p>{LONG} <a href=x>link</a></p><div><a href=/c>More of this</a></div>
    <div><a href=/d>Imprint</a></div>"""
    assert text_of(page) == f"The headline of it {LONG} Short one. {LONG} link"


def test_markup():
    def texts(page):
        return [b.text for b in blocks_of(page)]

    assert texts("<p>a&nbsp;b &lt;i&gt; &#x41;<b>c</b>d<p>e<br>f") == ["a b <i> Acd", "e f"]
    assert texts('<p>hello</p><script>var a="<p>no</p>"') == ["hello"]
    assert texts('<p>one</p><p class="cut') == ["one"]
    assert texts("<p>a < b and 3<4</p>") == ["a < b and 3<4"]
    assert texts('<a title="a > b" href=x>link</a> rest') == ["link rest"]
    assert texts('<p title="never closed>text</p><p>more</p>') == ["text", "more"]
    assert texts("<!-- x --><p>t</p><!--> y <p>u<!--- --><p>v<!-- end") == ["t", "y", "u", "v"]
    assert texts("<head><title>no</title><p>no head end</p>") == ["no head end"]
    assert texts("<div><button>go</div><p>x <svg><text>no</text></svg> y") == ["x", "y"]
    assert texts("</p></div>text<?php x ?><!DOCTYPE z>") == ["text"]
    assert [(b.words, b.linked) for b in blocks_of("<p>one <a>two three</a> four<p>five")] == [(4, 2), (1, 0)]
    # an article cannot stand in a menu that was never closed
    assert text_of("<nav><a href=/>Home</a><article><p>Body.</p></article>") == "Body."


def test_tree():
    rows = np.array(LABELLED, dtype=float)
    assert (kept(TREE, rows[:, :-1]) == rows[:, -1]).all()
    # brute force: the first split has the least impurity of all
    x, y = rows[:, :-1], rows[:, -1]

    def impurity(feature, limit):
        low = x[:, feature] <= limit
        return sum(2 * m.sum() * y[m].mean() * (1 - y[m].mean()) for m in (low, ~low) if m.any())

    least = min(impurity(f, v) for f in range(x.shape[1]) for v in x[:, f])
    assert impurity(TREE.feature, TREE.limit) == pytest.approx(least)
    assert grow(x[:1], y[:1]).feature == -1
    # left out rows are told from the others
    right = [kept(grow(np.delete(x, i, 0), np.delete(y, i)), x[i : i + 1])[0] == y[i] for i in range(len(x))]
    assert np.mean(right) > 0.85


def test_features():
    rows = features(blocks_of("<a>x</a><article><p>a b</p></article>"))
    assert rows.tolist() == [[1, 1, 0, 0, 2, 0, 0, 1], [2, 0, 1, 1, 0, 0, 1, 1]]


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, blocks string, text string"
    deep = "<div>" * 20_000 + "</section>" * 20_000 + "<article>" * 5_000 + "end"
    long = "<article>" + "<p>word &amp; word</p>" * 50_000
    rows = [
        (1, "u", None), (None, "u", ""), (2**60 + 1, None, "<article>a"), (3, "u", "  \t"), (4, "u", deep), (5, "u", long),
        (6, "u", "<article>same"), (6, "u", "<article>same"), (7, "u", "<" * 50_000), (8, "u", "<a " + "=" * 50_000)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], schema)
    found = {(r.page_id, r.url): r.blocks for r in main_texts(pages).collect()}
    assert len(found) == 9 and main_texts(pages).count() == 10
    assert found[1, "u"] == found[None, "u"] == found[3, "u"] == []
    assert found[2**60 + 1, None] == ["a"] and found[4, "u"] == ["end"] and len(found[5, "u"]) == 50_000
    assert found[7, "u"] == [] or found[7, "u"] == ["<" * 50_000]
    empty = spark.createDataFrame([], schema)
    assert main_texts(empty).count() == 0
