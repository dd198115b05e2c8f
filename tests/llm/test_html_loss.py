"""No text of an article is lost to broken markup or to a word in a class."""

import time

import pytest

from lodestar.llm.html_text import main_text as m


def paragraphs(n, word="text", size=60):
    return "".join(f"<p>{(word + ' ') * size}</p>" for _ in range(n))


@pytest.mark.parametrize("page,want", [
    ("<p data-x=it's>A</p><p data-y=it's>B</p>", "A\nB"),
    ("<p data-x='it'>A</p><p title=\"a > b\">B</p>", "A\nB"),
    ("<p =a 'b>A</p><p x = y>B</p><p x=>C</p>", "A\nB\nC"),
    ("<p a=\"x>A</p><p>B</p>", "A\nB"),
    ("<p title='class=sidebar'>A</p><p id=a class=b>B</p>", "A\nB"),
    ("<p>Let <math><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x=1</annotation></math> be.</p>",
     "Let x=1 be.")])
def test_attributes_and_formulas(page, want):
    assert m(f"<article><h1>T</h1>{page}</article>") == "T\n" + want


@pytest.mark.parametrize("name", ["notice-period", "share-prices", "banner-story", "social_history", "ad-hoc",
                                  "header2-physics", "respond-to-critics"])
def test_words_with_other_meanings_take_nothing_out(name):
    page = f"<article><h1>T</h1>{paragraphs(3)}<section class={name}><p>must stay</p></section></article>"
    assert m(page).endswith("must stay")
    page = f"<div class='{name}'>{paragraphs(6, 'long')}</div><div>{paragraphs(2, 'short')}</div>"
    assert "long long" in m(page)


@pytest.mark.parametrize("name", ["notice", "cookie-notice", "site_header", "share-buttons", "ad-slot", "ad",
                                  "post-comments", "comments-area", "sidebar-left", "related-posts", "social links",
                                  "newsletter-signup", "ads-728", "widget-area", "footer-links"])
def test_parts_that_say_what_they_are_go(name):
    page = f"<article><h1>T</h1>{paragraphs(2)}<div class='{name}'><p>{'away ' * 200}</p></div></article>"
    assert "away" not in m(page) and "text" in m(page)


def test_deep_and_broken_pages_take_linear_time():
    n = 40_000
    for page in ("<div>" * n + "deep" + "</div>" * n, "<b>" * n + "deep" + "</i>" * n, "<p a=\"x>" * n + "deep",
                 "<p x='" * n, "<li><div>" * n + "deep", "</p></div></td>" * n + "deep",
                 "<div class=sidebar>" * n + "deep" + "</div>" * n, "<article>" * n + "deep"):
        began = time.time()
        assert m(page) in ("deep", "")
        assert time.time() - began < 8, page[:30]
