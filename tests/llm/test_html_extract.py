"""Blocks of pages, and the extracted text against what the pages were made from."""

import re
import time
from html import escape, unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmetrics.llm import html_extract as op
from feedmetrics.llm.html_blocks import TAG_BITS, WORD_BITS, Buckets, Vectors, block_vectors, blocks
from feedmetrics.llm.recurrent import BiLstm, _pad

PAGES = "/root/testdata/sf0.01/pages.parquet"


def texts(html):
    return [b.text for b in blocks(html)]


def test_blocks():
    assert texts(None) == texts("") == texts("<p> \n </p>") == []
    assert texts("<p>a <b>b</b>c<br>d\n\t e&amp;&lt;f&nbsp;g</p>h") == ["a bc d e&<f g", "h"]
    assert texts('<script>var t="</p>x";</script><style>p{}</style><!-- <p>no</p> --><title>t</title><p>yes') == ["yes"]
    assert texts("<ul><li>one<li>two</ul>three</p>four") == ["one", "two", "threefour"]
    assert texts("<p>open<p>next<div>in</div>") == ["open", "next", "in"]
    assert texts("1 < 2 & 3 &unknown; &amp;lt;") == ["1 < 2 & 3 &unknown; &lt;"]
    assert texts("<script>never closed <p>x") == []
    assert texts("x" * 500_000) == ["x" * 500_000]
    assert texts("<div>" * 3000 + "deep" + "</div>" * 3000) == ["deep"]
    (block,) = blocks('<article class="post Main-text" id=x><h1><a href="/y?class=z">T</a></h1></article>')
    assert block.path[:4] == ("article", ".post", ".main", ".text") and block.linked == 1


def test_hidden_elements_take_no_other_text():
    # a name that only begins like that of a hidden element
    for tag in ("svg-icon", "title-bar", "template-card", "script-note", "style-x", "iframe-box"):
        assert texts(f"<p>a</p><{tag}></{tag}><article>main</article>") == ["a", "main"]
    # closed in its own tag, or never closed
    assert texts("<p>a</p><svg class=i/><article><p>main text</p></article>") == ["a", "main text"]
    assert texts('<p>a</p><svg d="M0>1" /><p>main <svg><text>no</text></svg>text</p>') == ["a", "main text"]
    for tag in ("svg", "template", "noscript"):
        assert texts(f"<p>a</p><{tag} class=i><article><p>main</article>") == ["a", "main"]
        assert texts(f"<p>a</p><{tag}><text>no</text></{tag.upper()}\n x><p>main") == ["a", "main"]
        assert texts(f"<{tag}>" * 20_000 + "<p>x") == ["x"]
    assert texts("<svg><p>main</p><svg><g>no</g></svg><p>end") == ["main", "end"]
    assert texts('<script data-x="a>b">no</script ><title lang=en>no</title\n><p>main') == ["main"]


def test_quotes_inside_tags():
    assert texts("<p title=it's>one</p><p>it's two</p>") == ["one", "it's two"]
    assert texts("<p title=5\">one</p><p title='>'>two</p><p title=\"it's>\">three") == ["one", "two", "three"]
    assert texts("<p it's>one</p><p title = 'a' b=c\"d>it's two</p>") == ["one", "it's two"]
    assert texts("<p title=>one</p><a href=x?y=z'>two</a>") == ["one", "two"]
    assert texts("<p " + "a='b' " * 5000) == ["<p " + ("a='b' " * 5000).strip()]
    (block,) = blocks("<p class=it's id=\"x y\">t")
    assert block.path == ("p", ".it", ".s", ".x", ".y")


HOSTILE = {
    "names": "<a" * 500_000, "one tag": "<" + "a" * 1_000_000, "marks": "<!" * 500_000, "signs": "<" * 1_000_000,
    "nested": "<div>" * 100_000 + "x" + "</div>" * 100_000, "nested text": "<div>x" * 100_000, "never closed": "<b>" * 100_000 + "<p>x" * 50_000,
    "hidden ends": "<a " * 300_000 + '="' + ">" + '"', "raw": "<script>" + "</script " * 100_000, "svg": "<svg>" + "</svg " * 100_000,
    "quotes": '<a b="' * 200_000, "other quotes": "<a b='\">" * 100_000, "equals": "<a =" * 200_000 + ">", "comments": "<!--" * 200_000,
    "white": ("<p =" + " " * 1000) * 1000, "cells": "<table><tr><td>x" * 30_000, "ends": "<b>" * 50_000 + "</i>" * 100_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_and_memory_grow_with_the_length(name):
    page, started = HOSTILE[name], time.monotonic()
    found = blocks(page)
    assert time.monotonic() - started < 15
    vectors = block_vectors(found, Buckets(TAG_BITS, 1), Buckets(WORD_BITS, 2))
    assert len(vectors) == len(found) and time.monotonic() - started < 40
    assert len(op.rule(blocks(page))) == len(found)


def test_hostile_pages_do_not_stop_a_job(spark):
    given = spark.read.parquet(PAGES).select("page_id", "url", "html").limit(40)
    extra = spark.createDataFrame([(10_000 + i, "u", h) for i, h in enumerate(HOSTILE.values())], given.schema)
    rows = op.extract(given.unionByName(extra)).collect()
    assert len(rows) == given.count() + len(HOSTILE)


def test_quotes_that_hide_every_end_count_no_more():
    assert texts('<p>one</p><a x="<p>two</p>"') == ["one", 'two"']
    assert texts('<p title="a>b">one</p>two') == ["one", "two"]


def test_vectors_are_what_their_dense_form_says():
    page = blocks("<div class='a b'><p>one two two</p><ul><li>three<a href=x>four</a></ul></div>five six. <p>" + "w " * 300)
    vectors = block_vectors(page, Buckets(TAG_BITS, 1), Buckets(WORD_BITS, 2))
    dense = vectors.dense()
    weights = np.random.default_rng(0).normal(size=(dense.shape[1], 5)).astype(np.float32)
    for held in (1, 3, 1000):
        assert np.allclose(vectors.times(weights, held), dense @ weights, atol=1e-4)
    assert (vectors.part(1, 3).dense() == dense[1:3]).all()
    assert (block_vectors(page, Buckets(TAG_BITS, 1), Buckets(WORD_BITS, 2), 1, 3).dense() == dense[1:3]).all()
    assert (Vectors.from_bytes(vectors.to_bytes()).dense() == dense).all()
    for row, block in zip(dense, page):
        assert set(np.flatnonzero(row[:TAG_BITS])) == {Buckets(TAG_BITS, 1)[n] for n in block.path}
    assert len(block_vectors([], Buckets(TAG_BITS, 1), Buckets(WORD_BITS, 2))) == 0


def test_gradients():
    rng = np.random.default_rng(0)
    model = BiLstm(5)
    x, real = _pad([rng.normal(size=(n, 5)).astype(np.float32) for n in (4, 2)])
    y, _ = _pad([np.array([1, 0, 1, 1], np.float32), np.array([0, 1], np.float32)])
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        m = model.margins(x.astype(np.float64), real)
        return float((np.logaddexp(0, np.where(y > 0, -m, m)) * real).sum() / real.sum())

    for name, g in model._gradients(x.astype(np.float64), real, y).items():
        at = tuple(int(rng.integers(0, n)) for n in g.shape)
        model.p[name][at] += 1e-4
        high = loss()
        model.p[name][at] -= 2e-4
        low = loss()
        model.p[name][at] += 1e-4
        assert abs((high - low) / 2e-4 - g[at]) < 1e-3, name


def article(html):
    """The main text of the given pages, from how they are laid out."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", inner)
    clean = [" ".join(unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p))).split()) for p in parts]
    return " ".join(c for c in clean if c)


def test_whole_table(spark):
    pages = spark.read.parquet(PAGES)
    rows = op.extract(pages).collect()
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(rows) == len(html)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    right = sum(r["text"] == article(html[r["page_id"]]) for r in rows)
    assert right == len(rows)


def layout(i, words):
    """A page of another site: (html, main text)."""
    def said(n, k):
        return " ".join(words[(i * 31 + k * 17 + j) % len(words)] for j in range(n))
    outer = ["main", "div class='content'", "article", "section id=post"][i % 4]
    main = [said(6, 1), said(40, 2), said(70, 3), said(25, 4)]
    body = f"<h1>{escape(main[0])}</h1>" + "".join(f"<p>{escape(m)}</p>" for m in main[1:])
    around = [
        f"<nav><ul><li><a href=x>{said(2, 5)}</a></li></ul></nav>", f"<aside><p>{said(30, 6)}</p></aside>",
        f"<div class='sidebar'><p>{said(25, 7)}</p></div>", f"<form><label>{said(2, 8)}</label><button>{said(1, 9)}</button></form>",
        f"<div id='comments'><div class='comment'><p>{said(35, 10)}</p></div></div>", f"<div class='cookie notice'>{said(12, 11)}</div>"]
    before, after = around[0] + around[1 + i % 5], around[1 + (i + 2) % 5]
    return f"<html><body>{before}<{outer}>{body}</{outer.split()[0]}>{after}<footer>{said(8, 12)}</footer></body></html>", " ".join(main)


def test_other_layouts(spark):
    given = spark.read.parquet(PAGES).select("page_id", "url", "html")
    words = sorted({w for r in given.limit(5).collect() for w in article(r["html"]).split()})
    made = [layout(i, words) for i in range(60)]
    extra = spark.createDataFrame([(10_000 + i, "u", h) for i, (h, _) in enumerate(made)], given.schema)
    rows = op.extract(given.unionByName(extra).withColumn("text", F.lit("clash"))).filter("page_id >= 10000").collect()
    right = sum(r["text"] == made[r["page_id"] - 10_000][1] for r in rows)
    assert right >= 0.9 * len(made), right


def test_edges(spark):
    schema = "page_id long, url string, html string"
    assert op.extract(spark.createDataFrame([], schema)).collect() == []
    rows = op.extract(spark.createDataFrame([(1, None, None), (None, "u", ""), (1, "u", "<p> </p>")], schema)).collect()
    assert [(r["text"], r["n_chars"], r["n_blocks"]) for r in rows] == [("", 0, 0)] * 3
