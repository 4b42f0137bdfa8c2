"""Main text of pages (malformed HTML included)."""

from conftest import one_col
from curata.functions.html import extract_main_text, extract_page_text, main_text


def test_article_first():
    html = ("<html><head><title>T</title><style>p{}</style></head><body><nav><p>menu</p></nav>"
            "<article><h1>Head &amp; more</h1><p>One <b>two</b></p><script>x()</script>"
            "<footer>f</footer><!-- c -->tail</article><article>second</article></body></html>")
    assert extract_main_text(html) == "Head & moreOnetwotail"


def test_div_fallback_and_whole_page():
    assert extract_main_text('<div class="x content"><p>in div</p></div><p>out</p>') == "in div"
    assert extract_main_text('<div class="article-text">a<div>b</div></div>c') == "ab"
    assert extract_main_text("<title>T</title><p>no container</p>") == "Tno container"


def test_malformed():
    # unclosed tags run to the end of their parent; stray end tags are ignored
    assert extract_main_text("<article><p>a<nav>hidden<p>still hidden</article>after") == "a"
    assert extract_main_text("<article>x</span>y</p>z</article>") == "xyz"
    assert extract_main_text("<nav><article>in nav</article></nav><p>body</p>") == "body"
    assert extract_main_text("<article>&quot;q&quot; &lt;tag&gt; &#233;</article>") == '"q" <tag> é'
    assert extract_main_text(None) is None
    assert extract_main_text("<article>" + "w" * 3000 + "</article>") == "w" * 2000


def test_page_text():
    html = "<head><title>T</title></head><body><nav>Menu</nav><p>Para   one</p><div>Two<br>Three</div></body>"
    assert extract_page_text(html) == "Menu\nPara one\nTwo\nThree"


def test_udf_matches_python(spark):
    pages = ["<article>a<b>b</b></article>", "<div class='content'>c</div>", None, "<p>d</p>"]
    assert one_col(spark, pages, main_text) == [extract_main_text(p) for p in pages]


def test_strings_that_are_no_text():
    from curata.functions.html import extract_main_text
    assert extract_main_text("<article>a<template>x<b>y</b></template><ruby>k<rp>(</rp><rt>z</rt></ruby></article>") == "ak"
