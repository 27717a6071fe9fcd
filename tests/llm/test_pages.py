"""Pages whose text is found by density, without any marks, or by several marks."""

import math

import pytest

from papyra.llm.html_text import Page, extract_text

PROSE = "This is a sentence of the article, long enough to count as prose among the other parts. "
LONG = "".join(f"<p>{PROSE * 3}{i}</p>" for i in range(6))
TEXT = [f"{(PROSE * 3).strip()} {i}" for i in range(6)]
MENU = "<div><a href=1>Home</a> <a href=2>News</a> <a href=3>Sport</a></div>"


def lines(body):
    return Page(f"<html><body>{body}</body></html>").main_text().split("\n")


def test_short_sections_beside_the_longest_are_kept():
    page = f"{MENU}<div id=content><h1>A</h1><section>{LONG}</section><section><h2>B</h2><p>Short end.</p></section></div>"
    assert lines(page) == ["A", *TEXT, "B", "Short end."]
    page = f"{MENU}<section>{LONG}</section><section><p>Short end.</p></section><div>Copyright 2021 Us. All rights reserved.</div>"
    assert lines(page) == [*TEXT, "Short end."]


def test_all_articles_of_a_main_are_kept():
    second = f"<p>{PROSE}</p><p>{PROSE}</p>"
    page = f"{MENU}<main><article>{LONG}</article><article>{second}</article></main>"
    assert lines(page) == [*TEXT, PROSE.strip(), PROSE.strip()]
    teasers = "".join(f"<article><a href={i}>Another story of the day</a></article>" for i in range(5))
    assert lines(f"<main><article>{LONG}</article>{teasers}</main>") == TEXT


@pytest.mark.parametrize("extra", [
    "<div class=share-buttons>Share this</div>", "<div class='author-box'>Ann writes here.</div>",
    "<div class=post-tags>One, two</div>", "<ul><li><a href=1>More of this</a><li><a href=2>And that</a></ul>",
    "<div class=read-more><a href=1>Read more</a></div>",
])
def test_parts_inside_an_article_that_are_no_text(extra):
    assert lines(f"<article>{LONG}{extra}</article>") == TEXT
    assert lines(f"{MENU}<div>{LONG}{extra}</div>") == TEXT


def test_names_that_only_sound_like_parts_are_text():
    kept = "<p class=author>By Ann</p><h2><a href=1>Part</a></h2><p>Copyright law is hard. <a href=1>See here</a></p>"
    assert lines(f"<article>{LONG}{kept}</article>")[6:] == ["By Ann", "Part", "Copyright law is hard. See here"]


def test_clean_unmarked_pages_keep_their_words():
    page = f"<div><div>{MENU}</div><div><h1>T</h1>{LONG}</div><div><a href=1>x</a> | <a href=2>y</a></div></div>"
    assert lines(page) == ["T", *TEXT]


def test_density_equals_the_published_formula():
    """Characters a tag, weighed by the logarithm to a base of the page's own link share."""
    page = Page("<div><p>abcdefghij <a href=x>klmno</a></p><p>pqrst</p></div>")
    # tags: html 0, div 1, p 2, a 3, p 4
    c, links, tags, link_tags = {1: 20, 2: 15, 4: 5}, {1: 5, 2: 5, 4: 0}, {1: 3, 2: 1, 4: 0}, {1: 1, 2: 1, 4: 0}
    share, found = 5 / 20, page.densities()
    for node in (1, 2, 4):
        base = math.log(c[node] / max(c[node] - links[node], 1) * links[node] + share * c[node] + math.e)
        inner = c[node] / max(links[node], 1) * max(tags[node], 1) / max(link_tags[node], 1)
        expected = c[node] / max(tags[node], 1) * math.log(max(inner, 1)) / math.log(base)
        assert found[node] == pytest.approx(expected, rel=0.15)


def test_text_ids(spark):
    rows = [("k1", "u", f"<article>{LONG}</article>", 1), (None, None, None, 2), ("k1", "u", "", 3)]
    found = extract_text(spark.createDataFrame(rows, "page_id string, url string, html string, text int"))
    assert sorted((repr(r.page_id), r.text == "\n".join(TEXT)) for r in found.collect()) == [
        ("'k1'", False), ("'k1'", True), ("None", False),
    ]
