"""Pages whose text is easily lost."""

from __future__ import annotations

import pytest

from sievemart.llm import html_text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>a</p><svg/><p>rest of page</p>", "a\nrest of page"),
        ("<p>a</p><svg><p>rest of page</p>", "a\nrest of page"),
        ("<p>a</p><svg><svg><text>x</text></svg> y</svg><p>rest</p>", "a\nrest"),
        ("<title-bar>one</title-bar><p>two</p>", "one\ntwo"),
        ("<p>so <math><mi>x</mi></math> is</p>", "so x is"),
        ("<title>never closed <p>x</p>", ""),
    ],
)
def test_raw_elements_take_no_article_text(html, text):
    assert html_text.main_text(html, {}) == text


@pytest.mark.parametrize(
    "wrapper",
    ['class="layout has-sidebar"', 'class="no-sidebar"', 'class="with-nav"', 'id="search-results"', 'class="legal-text"', 'class="widget"', 'data-id="social"'],
)
def test_wrappers_do_not_take_the_article(wrapper):
    assert html_text.main_text(f"<div {wrapper}><article><p>all of it</p></article></div>", {}) == "all of it"


def test_attributes_are_read_whole():
    html = '<p>see <a href="/item?id=5&ref=share">this link</a> <b data-id="social">and this</b></p>'
    assert html_text.main_text(html, {}) == "see this link and this"
    assert html_text.main_text('<p>a b</p><div class="cookie-notice">no</div>', {}) == "a b"


def test_kinds_beyond_the_bound_have_their_tags_counts(spark, monkeypatch):
    """Every page has its own class for what stands outside; no count is dropped."""
    html = "<div class='site{0}x'>menu of site number {0}</div><article><p>text</p></article>"
    pages = spark.createDataFrame([(i, html.format(i)) for i in range(400)], "page_id long, html string")
    monkeypatch.setattr(html_text, "KINDS", 8)
    weights = html_text.learn_weights(pages.coalesce(1))
    assert weights["words div.*"] == html_text._weight("words div.*", 0, 400 * 5)
    page = "<div class='unseen'>a menu of five words</div><p>text</p>"
    assert html_text.main_text(page, dict(weights)) == "text"
