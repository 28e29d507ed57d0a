"""Main text: markup cases, templates counted per host, edge rows."""

import html
import re

import pytest

from logharbor.llm import html_text as h
from logharbor.llm.queries import QUERIES

CASES = [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b", "a b"), ("<p>a<b>b</b>c<br>d</p>", "abc d"),
    ("<article><h1>T</h1><p>x&nbsp;&lt;y&gt;\n\n z</p></article><footer>f</footer>", "T x <y> z"),
    ("<body><nav>n</nav><main><p>m</p><aside>s</aside></main><p>out</p></body>", "m"),
    ('<div class="sidebar">s</div><div id="content"><p>c</p><div class="comments"><p>hi</p></div></div>', "c"),
    ('<article><p>one</p><div class="ad">buy</div><p>two</p><form>f</form><script>var a="<p>no</p>";</script></article>', "one two"),
    ("<article><p>a<!-- <p>hidden</p> --></p><style>p{}</style></article>", "a"),
    ('<article><ul><li>a<li>b</ul><table><tr><td>1<td>2</table></article>', "a b 1 2"),
    ("<div class='cookie-notice'>We use</div><p>t</p>", "t"), ("<p>unclosed <b", "unclosed <b"), ("a < b and c > d", "a < b and c > d"),
    ("<article><p hidden>x</p><p aria-hidden=true>y</p><p style='display: none'>z</p><p>v</p></article>", "v"),
    ('<div id="page-header">Site</div><p>t</p><ol class="commentList"><li>hi</ol>', "t"),
    ('<article><div class="post-header">Title</div><p>b</p></article>', "Title b"),
    ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>b</p></article>", "Title b"),
]


@pytest.mark.parametrize("source,text", CASES)
def test_markup(source, text):
    assert h.main_text(source) == text


def page(body, sentence):
    return f"<html><body><div><a href='/'>Home</a> | <a href='/x'>About us</a></div><div><p>{sentence}</p><p>{body}</p></div><div>All rights kept</div></body></html>"


def test_templates_are_counted_per_host(spark):
    rows = [(k, f"http://big.example/{k}", page(f"own words {k}", f"and more {k}")) for k in range(8)]
    rows += [(100 + k, f"http://user@small.example:80/{k}", page(f"other {k}", "same")) for k in range(2)]
    rows += [(200, None, page("no host", "x")), (201, "nonsense", None), (None, "http://big.example/9", ""), (0, "http://big.example/0", rows[0][2])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in h.extract(df).collect()}
    assert h.extract(df).count() == len(rows)
    for k in range(8):
        assert got[k, f"http://big.example/{k}"][0] == f"and more {k} own words {k}"
    assert got[100, "http://user@small.example:80/0"][0] == "Home | About us same other 0 All rights kept"
    assert got[200, None][0] == "Home | About us x no host All rights kept"
    assert got[201, "nonsense"] == ("", 0) and got[None, "http://big.example/9"] == ("", 0)
    assert h.extract(df.limit(0)).count() == 0


def test_recurring_paragraphs_of_articles_stay(spark):
    rows = [(k, f"http://h.example/{k}", f"<nav>m{k}</nav><article><p>the same words</p><ul><li><a href='/a'>more</a></ul><p>{k}</p></article>") for k in range(9)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.text for r in h.extract(df).collect()} == {f"the same words {k}" for k in range(9)}


def test_long_page_is_whole():
    body = "".join(f"<p>word{k} <i>x</i></p>" for k in range(20000))
    assert h.main_text(f"<article>{body}</article>") == " ".join(f"word{k} x" for k in range(20000))
    deep = "<div>" * 20000 + "deep" + "</div>" * 20000
    assert h.main_text(deep) == "deep"


def test_query_against_the_given_pages(spark, sf_dir):
    """These pages hold their text in one article of headings and paragraphs."""
    source = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op3_site_templates"](spark, sf_dir).collect()
    assert len(rows) == len(source)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", source[r.page_id].html, re.DOTALL).group(1)
        parts = [html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == " ".join(w for p in parts for w in p.split())
        assert r.n_chars == len(r.text) and r.url == source[r.page_id].url
