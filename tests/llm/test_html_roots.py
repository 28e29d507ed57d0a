"""Recurring blocks inside content roots, whole roots, and counts that do not grow with the host."""

import pytest

from logharbor.llm import html_text as h

DDL = "page_id bigint, url string, html string"


def texts(spark, sources):
    rows = [(k, f"http://h.example/{k}", s) for k, s in enumerate(sources)]
    return {r.page_id: r.text for r in h.extract(spark.createDataFrame(rows, DDL)).collect()}


@pytest.mark.parametrize("source,text", [
    ("<main><h1>T</h1><p>text</p><article>x</article></main>", "T text x"),
    ("<main><article>x</article></main><article>y</article>", "x y"),
    ("<main><p>a</p></main><div>out</div><main><p>b</p></main>", "a b"),
    ('<div class="post"><p>a</p></div><p>out</p><div class="entry"><div class="content">longer b</div></div>', "a longer b"),
    ('<div itemprop="articleBody">a</div><div class="post">b</div>', "a b"),
])
def test_all_roots_are_taken(source, text):
    assert h.main_text(source) == text


def test_unmarked_notice_inside_roots_goes(spark):
    notice = "<div><p>Read our terms first</p></div>"
    got = texts(spark, [f"<{tag}><p>own {k}</p>{notice}<p>end</p></{tag}>" for k in range(6) for tag in ("article", "main")])
    assert all("terms" not in t for t in got.values())
    assert got[0] == "own 0 end" and got[1] == "own 0"


def test_copies_of_an_article_stay_whole(spark):
    got = texts(spark, [f"<p>frame {k}</p><article><div>a block</div><p>b</p></article>" for k in range(9)])
    assert set(got.values()) == {"a block b"}


def test_section_block_of_a_large_host_goes(spark):
    block = "<div>Section notice</div>"
    got = texts(spark, [f"<body><p>own <b>bold</b> {k}</p>{block if k < 6 else ''}</body>" for k in range(60)])
    assert got == {k: f"own bold {k}" for k in range(60)}
