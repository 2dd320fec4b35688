from __future__ import annotations

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from heliovane.llm.render import aligned, page_texts, render

PAGE = "page_id bigint, url string, html string"

CASES = {
    "implied ends": ("<p>a<p>b<div>c</div>d", "a\n\nb\n\nc\nd"),
    "inline": ("<p>a <b> b</b>  c<i>d</i>\n e", "a b cd e"),
    "break": ("<p>a<br>b<br><br>c", "a\nb\n\nc"),
    "headings": ("<h1>T<h2>U</h2>text", "T\n\nU\n\ntext"),
    "lists": ("<ul><li>a<li>b<ol start=9><li>c<li>d</ol></ul>", "- a\n- b\n  9. c\n  10. d"),
    "item of paragraphs": ("<ul><li><p>a<p>b<li>c</ul>", "- a\n\n  b\n\n- c"),
    "table": ("<table><tr><th>Name<th>N<tr><td>Alice B<td>1</table>", "Name     N\nAlice B  1"),
    "column span": (
        "<table><tr><td colspan=2>ab cd ef<td>x<tr><td>a<td>b<td>y</table>",
        "ab cd ef  x\na  b      y",
    ),
    "row span": ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    "lines in cells": ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    "table in a cell": ("<table><tr><td><table><tr><td>a<td>b</table><td>c</table>", "a  b  c"),
    "sections and caption": (
        "<table><caption>C</caption><thead><tr><th>h<tbody><tr><td>d</table>after",
        "C\nh\nd\n\nafter",
    ),
    "preformatted": ("<pre>\n a\n\n  b</pre>c", " a\n\n  b\n\nc"),
    "definitions and quotes": ("<dl><dt>t<dd>d</dl><blockquote>q</blockquote>", "t\n  d\n\n  q"),
    "not shown": (
        "<head><title>t</title><script>x</script></head><p hidden>a</p><p style='DISPLAY : none'>b</p>"
        "<div style='visibility:hidden'>c</div><template>d</template><noscript>e</noscript>"
        "<input type=hidden value=f><!-- g -->h<details><summary>i</summary>j</details><details open>k</details>",
        "h\ni\nk",
    ),
    "style sheet": (
        "<style>/* .z{display:none} */ .ad, #x {color:red;display: none} div.y{visibility:hidden}</style>"
        "<p class='b ad'>a</p><p id=x>b</p><p class=y>c</p><div class='y'>d</div><p class=z>e</p>",
        "c\n\ne",
    ),
    "entities": ("a &amp; &lt;b&gt; &copy; &#233; &bogus;", "a & <b> © é &bogus;"),
    "broken": ("</div></p>a</b><td>b</tr>c<p", "abc"),
    "head ends at text": ("<html><head><meta x>loose<body>b", "loose\nb"),
    "unclosed script": ("a<script>b", "a"),
    "nothing": ("", ""),
    "null": (None, ""),
    "white space": (" \n\t ", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    page, text = CASES[name]
    assert render(page) == text

# Style sheets, attributes of the style element, and which of a to f a screen shows of PARTS.
PARTS = "<p class=a>a</p><p class='b x'>b</p><p id=c>c</p><div>d</div><p style='display:none'>e</p><p style='display:block'>f</p>"
SHEETS = {
    "print": ("@media print{p,.a{display:none}}", "", "abcdf"),
    "narrow": ("@media (max-width:600px){.a{display:none}} #c{display:none}", "", "abdf"),
    "narrow range": ("@media (width <= 37.5em), print and (color){.a{display:none}}", "", "abcdf"),
    "wide": ("@media only screen and (min-width:600px) and (orientation:landscape){.a{display:none}}", "", "bcdf"),
    "not print": ("@media not print{.a{display:none}}", "", "bcdf"),
    "not known": ("@media not (odd:1){.a{display:none}} @media (odd){.b{display:none}}", "", "abcdf"),
    "nested groups": ("@supports (display:grid){@media print{.a{display:none}} .b{display:none}}", "", "acdf"),
    "frames": ("@keyframes k{from{visibility:hidden}p{display:none}} @page{display:none}", "", "abcdf"),
    "after a statement": ("@import 'x.css'; .a{display:none}", "", "bcdf"),
    "later shows": (".a{display:none} .a{display:block}", "", "abcdf"),
    "later hides": (".a{display:block} .a{display:none}", "", "bcdf"),
    "later in the rule": (".a{display:none;display:block}", "", "abcdf"),
    "more exact": ("p.a{display:block} #c{display:block} .a,p{display:none}", "", "acdf"),
    "important": (".a{display:none!important} .a{display:block} p{display:block ! important}", "", "bcdef"),
    "two properties": (".a{visibility:hidden} .a{display:block} .b{visibility:collapse} .x{visibility:visible}", "", "bcdf"),
    "braces in strings": (".z::before{content:'}'} .a{content:\"{\";display:none}", "", "bcdf"),
    "rule in a rule": (".a{color:red;&:hover{display:none}} .b{i{color:red} display:none}", "", "acdf"),
    "open at the end": ("@media print{.a{display:none}", "", "abcdf"),
    "print sheet": (".a{display:none}", " media=print", "abcdf"),
    "screen sheet": (".a{display:none}", " media='screen, print'", "bcdf"),
}


@pytest.mark.parametrize("name", SHEETS)
def test_style_sheets_of_a_screen(name):
    sheet, attributes, shown = SHEETS[name]
    assert "".join(render(f"<style{attributes}>{sheet}</style>{PARTS}").split()) == shown


# Style sheets, a page's body, and what a screen shows of it.
SELECTED = {
    "visible in invisible": ("", "<div style='visibility:hidden'>a<p style='visibility:visible'>b</p>c</div>d", "bd"),
    "invisible inherits": (".x{visibility:hidden} .y{visibility:inherit}", "<div class=x>a<p class=y>b</p><i>c</i></div>d", "d"),
    "visible but not displayed": (".y{visibility:visible}", "<div style='display:none'><p class=y>b</p></div>d", "d"),
    "display over hidden": (".x{display:block}", "<p hidden class=x>a</p><p hidden>b</p>", "a"),
    "hidden reverted": (".x{display:block} p.x{display:revert}", "<p hidden class=x>a</p><p class=x>b</p>", "b"),
    "dialog displayed": ("dialog{display:block}", "<dialog>a</dialog>", "a"),
    "descendant": ("nav .x{display:none}", "<nav><b><i class=x>a</i></b></nav><i class=x>b</i>", "b"),
    "child": (".y>p{display:none}", "<div class=y><p>a</p><div><p>b</p></div></div>", "b"),
    "child of child": ("div > .y > p{display:none}", "<div><div class=y><p>a</p></div></div><section><div class=y><p>b</p></div></section>", "b"),
    "either way up": (".a > .b .c{display:none}", "<div class=a><div class=b><div class=b><p class=c>x</p></div></div></div>", ""),
    "next": ("h1 + p{display:none}", "<h1>a</h1><p>b</p><p>c</p>", "ac"),
    "later": ("h1 ~ p{display:none}", "<p>a</p><h1>b</h1><div>c</div><p>d</p><p>e</p>", "abc"),
    "attribute": ("[aria-hidden=true]{display:none}", "<p aria-hidden=true>a</p><p aria-hidden=false>b</p>", "b"),
    "attributes": ("p[data-a]:not([data-a^='x' i]){display:none}", "<p data-a=XY>a</p><p data-a=y>b</p><p>c</p>", "ac"),
    "attribute parts": ("[a~=x],[b|=en],[c$='z,'],[d*=q]{display:none}", "<p a='w x'>a</p><p b=en-US>b</p><p c='yz,'>c</p><p d=aqa>d</p><p a=xx b=english>e</p>", "e"),
    "not and is": ("p:not(.k, #m):is(.j, .l){display:none}", "<p class='k j'>a</p><p class=l>b</p><p id=m class=j>c</p><p>d</p>", "acd"),
    "places": ("li:first-child,li:nth-child(3n+2),li:last-child{display:none}", "<ul><li>a<li>b<li>c<li>d<li>e<li>f<li>g</ul>", "-c-d-f"),
    "places of a tag": ("p:nth-of-type(even),p:nth-last-of-type(1){display:none}", "<div><p>a</p><b>x</b><p>b</p><p>c</p><p>d</p><p>e</p></div>", "axc"),
    "nobody there": ("p:hover{display:none} p:focus-within b{display:none}", "<p>a<b>b</b></p>", "ab"),
    "not known": ("p:odd-thing{display:none} p::before{display:none} p:not(:odd){display:none}", "<p>a</p>", "a"),
    "weights": ("#i{display:block} div p.x:not(.z){display:none} .x{display:block}", "<div><p class=x>a</p><p class=x id=i>b</p></div>", "b"),
    "root": (":root > body > p{display:none}", "<html><body><p>a</p><div>b</div></body></html>", "b"),
    "marks and quotes": (".x{visibility:hidden} .y{visibility:visible}", "<ol><li>a<li class=x>b<q>c</q><b class=y>d</b><li>e</ol>", "1.ad3.e"),
    "cells keep their places": (".x{visibility:hidden}", "<table><tr><td class=x>aa<td>b<tr><td>c<td>d</table>", "bcd"),
}


@pytest.mark.parametrize("name", SELECTED)
def test_selectors_and_inheritance(name):
    sheet, body, shown = SELECTED[name]
    assert "".join(render(f"<style>{sheet}</style>{body}").split()) == shown


def test_selectors_of_large_and_deep_pages():
    sheet = "<style>div.x p, div ~ p, p:nth-last-child(2n), div div div p{display:none}</style>"
    assert render(sheet + "<div>" * 5_000 + "<p>a").strip() == ""
    rows = "".join(f"<p>{k}</p>" for k in range(5_001))
    assert len(render(f"{sheet}<section>{rows}</section>").split()) == 2_501
    assert render("<style>" + "a " * 5_000 + "{display:none}" + "p" + ":not(p" * 500 + "{display:none}</style><p>x") == "x"


def test_odd_style_sheets_end():
    assert render("<style>" + "@media all{" * 50_000 + ".a{display:none}</style><p class=a>a<p>b") == "b"
    assert render("<style>" + ";{}}" * 50_000 + "</style>x") == "x"


def visible_words(page):
    """Words of well-formed pages by plain substitution."""
    page = re.sub(r"(?s)<!--.*?-->|<head>.*?</head>|<script.*?</script>", " ", page)
    return html.unescape(re.sub(r"</?(?:b|i|a)\b[^>]*>", "", re.sub(r"<(?!/?(?:b|i|a)\b)[^>]*>", " ", page))).split()


def test_all_words_of_the_pages_come_out(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    texts = {r["page_id"]: r["text"] for r in page_texts(pages).collect()}
    rows = pages.collect()
    assert len(texts) == len(rows)
    for r in rows:
        words = [w for w in texts[r["page_id"]].split() if w != "-"]
        assert words == [w for w in visible_words(r["html"]) if w != "-"]


def test_deep_and_long_pages():
    assert render("<div>" * 50_000 + "x") == "x"
    assert render("<b><p>" * 5_000 + "x") == "x"
    assert render("<ul><li>" * 300 + "x").strip(" -") == "x"
    assert len(render("<p>word " * 50_000)) == 50_000 * 6 - 2
    assert render("<" * 2000).strip("<") == ""


def test_random_markup_never_fails():
    rng = random.Random(1)
    tags = "div p ul ol li table tr td th b a pre br script style head body dl dt dd select option svg details".split()
    for _ in range(500):
        parts = []
        for _ in range(rng.randrange(60)):
            tag = rng.choice(tags)
            parts.append(rng.choice([f"<{tag}>", f"</{tag}>", f"<{tag}/>", "word", " ", "<", "&", f"<{tag} colspan=3 rowspan=0 class=x>"]))
        assert isinstance(render("".join(parts)), str)


def test_alignment():
    cell = lambda *lines: (list(lines), 1, 1)
    assert aligned([[cell("a"), cell("bb", "c")], [cell("long"), cell("d")]]) == ["a     bb", "      c", "long  d"]
    assert aligned([]) == [] and aligned([[]]) == []


def test_rows_of_a_table(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (2, None, None), (None, None, "x"), (3, "u", "")]
    pages = spark.createDataFrame(rows, PAGE).withColumn("text", F.lit("clash"))
    got = sorted(map(tuple, page_texts(pages).collect()), key=str)
    assert got == sorted([(1, "a"), (1, "a"), (2, ""), (None, "x"), (3, "")], key=str)
    assert page_texts(spark.createDataFrame([], PAGE)).collect() == []
