"""Markup that never closes takes time in proportion to its length; names mark an element as wholes."""

import time

import pytest

from logharbor.llm import html_text as h

BROKEN = {
    "quotes": '<a "' * 250_000, "names": "<a" * 500_000, "quoted ends": '<b ">"' * 170_000 + '"', "both quotes": "<a '\"" * 200_000,
    "closing tags": "<i>" * 140_000 + "</b>" * 140_000, "closing tags in a scope": "<b><div>" + "<i>" * 140_000 + "</b>" * 140_000,
    "blocks in inline": "<div>" + "<i>" * 125_000 + "<hr>" * 125_000, "bodies": "<p>" * 110_000 + "<body>" * 110_000,
    "items": "<p><i>" * 90_000 + "<li>" * 90_000, "cells": "<table>" + "<td><i>" * 140_000, "attributes": "<a " + "a= " * 330_000 + ">",
    "less-than": "<" * 1_000_000,
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_markup_is_linear(name):
    started = time.monotonic()
    h.main_text(BROKEN[name])
    h.subtree_hashes(BROKEN[name])
    assert time.monotonic() - started < 60


@pytest.mark.parametrize("source, text", [
    ('<article><p>one</p><div class="ad-free content"><p>body text</p></div></article>', "one body text"),
    ('<body><div class="social-science"><p>t</p></div></body>', "t"),
    ('<article><p class="notice-board-history">kept</p></article>', "kept"),
    ('<article><p>t</p><div class="ad-banner">x</div><div id="userComments">y</div><div class="site-notice">z</div></article>', "t"),
    ('<div class="siteNav">n</div><div class="main-content"><p>t</p></div><div class="page-footer">f</div>', "t"),
    ('<div class="post-header">T</div><p>body</p>', "body"),
])
def test_compound_names(source, text):
    assert h.main_text(source) == text


@pytest.mark.parametrize("source, text", [
    ('<p>a <a "b</p><p>c</p>', 'a <a "b c'), ("<p>x</p><a title='y", "x <a title='y"), ("<p>a<b", "a<b"),
    ('<p>it <i title=">">is</i></p>', "it is"), ("<p>a</i></b>b</p></div>c", "ab c"),
])
def test_tags_that_never_close_are_text(source, text):
    assert h.main_text(source) == text
