"""Extraction from pages of many forms, and from the whole table against a plain reading of its form."""

import re
import time
from html import unescape

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clientele.llm.html_extract import extract_text, main_text
from clientele.llm.html_tree import parse
from clientele.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"

A = "The first paragraph of the article, which is long enough, says what it is about."
B = "A second paragraph follows, with commas, with clauses, and with a number of further words in it."
C = "Short end."
MENU = "<nav><ul><li><a href=/>Home</a><li><a href=/x>News, sport, and all the rest of our pages</a></ul></nav>"
FOOT = "<footer><p>Copyright, all rights reserved, by the owners of this page, whoever they are.</p></footer>"


def page(body, head=""):
    return f"<!doctype html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "body, want",
    [
        (f"{MENU}<article><h1>Title</h1><p>{A}<p>{B}<p>{C}</article>{FOOT}", ["Title", A, B, C]),
        # no element says what it is
        (f"<div class=top><a href=1>One</a> <a href=2>Two</a></div><div id=c><p>{A}</p><p>{B}</p><p>{C}</p></div>"
         f"<div><a href=3>Three, four, five, and many more words in a link</a></div>", [A, B, C]),
        # text in boxes, not in paragraphs
        (f"<div class='content'><div>{A}</div><div>{B}</div><div>{C}</div></div><div class='side-bar'>{B}</div>", [A, B, C]),
        # sections share the article
        (f"<main><section><h2>One</h2><p>{A}</p></section><section><h2>Two</h2><p>{B}</p></section></main>{FOOT}",
         ["One", A, "Two", B]),
        # a table for the layout
        (f"<table><tr><td class=menu><a href=1>Home</a><td><p>{A}<p>{B}<td class=ads>{A}</table>", [A, B]),
        # lines, ended by two breaks
        (f"<div id=main>{A}<br><br>{B}<br>{C}</div>", [A, f"{B} {C}"]),
        # the heading before the container, and siblings that score
        (f"<div><h1>Title</h1><div class=a><p>{A}</p><p>{B}</p></div><div class=b><p>{B}</p><p>{A}</p></div></div>",
         ["Title", A, B, B, A]),
        # reader comments, longer than the article, as articles
        (f"<div id=post><h1>Title</h1><p>{A}</p><p>{B}</p></div><div id=comments>"
         + f"<article class=comment><p>{B}</p></article>" * 9 + "</div>", ["Title", A, B]),
        (f"<article><p>{A}</p><p>{B}</p><section class='post-comments'><h3>3 Comments</h3><p>{B}</p></section></article>",
         [A, B]),
        # notices, adverts, forms and hidden parts within the article
        (f"<article><div class='cookie-banner'>{B}</div><p>{A}</p><div id='ad-slot-2'>{B}</div><form>Name <input> {B}"
         f"</form><p>{B}</p><p hidden>{A}</p><div style='display: none'>{A}</div><div aria-hidden=true>{A}</div>"
         f"<div role=alert>{A}</div><aside>{A}</aside><button>More</button><noscript>{A}</noscript></article>", [A, B]),
        # a box of links is a menu, links in a sentence are not
        (f"<article><p>{A}</p><ul><li><a href=1>Some other page</a><li><a href=2>One more page</a><li><a href=3>And "
         f"a third</a></ul><p>See <a href=4>this</a>, {B}</p></article>", [A, f"See this, {B}"]),
        (f"<article><p>{A}</p><ul><li>{B}<li>{C}</ul><ol><li><p>{A}</ol></article>", [A, B, C, A]),
        # a form around the whole page
        (f"<form action=x><div class=nav><a href=1>Home</a></div><div><p>{A}</p><p>{B}</p></div></form>", [A, B]),
        # a page's name may speak of its parts
        (f"<div class='page has-sidebar no-comments'><div class=shadow><p>{A}</p><p>{B}</p></div></div>", [A, B]),
        # page header and article header
        (f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{A}</p></article>", ["Title", A]),
        # short texts only
        ("<nav>Menu</nav><article><h1>Hi</h1><p>One.<p>Two.</article><div class=x>Other</div>", ["Hi", "One.", "Two."]),
        ("<p>One.<p>Two.", ["One.", "Two."]),
        (f"<article><p>{A}</p><blockquote><p>{B}</p></blockquote><pre>{C}\n  {C}</pre><dl><dt>Term<dd>Meaning</dl></article>",
         [A, B, f"{C} {C}", "Term", "Meaning"]),
        (f"<article><h2>Data</h2><p>{A}</p><table><tr><th>Year<th>Sum<tr><td>1999<td>12</table></article>",
         ["Data", A, "Year", "Sum", "1999", "12"]),
        ("", []),
        (MENU + FOOT, []),
    ],
)
def test_pages(body, want):
    assert main_text(page(body)) == "\n\n".join(want)
    assert main_text(body) == "\n\n".join(want)


@pytest.mark.parametrize(
    "html, want",
    [
        ("a &amp;amp; b &lt;b&gt; &copy &#233;&#x20AC; &nbsp; c&bogus; &am", "a &amp; b <b> © é€ c&bogus; &am"),
        ("x <b>bo<i>ld</b></i>er <em>y", "x bolder y"),
        ("1 < 2 <3 <- a<!-- <p>no --> b<!-->c<!--->d<!-- x --!>e<? f>g</ >h", "1 < 2 <3 <- a bcdegh"),
        ("<script>var t = '<p>no</p>' </script >a<style>p{}</STYLE>b<textarea><p>no</textarea>c", "abc"),
        ("<a href='x>y' title=\"<p>\">in</a> <a href=un'quoted>out</a>", "in out"),
        ("a<div>b<div>c</span></p>d</div>e</section>f</div>g", "a\n\nb\n\nc\n\nd\n\nef\n\ng"),
        ("<p>a<div>b</p>c</div>d", "a\n\nb\n\nc\n\nd"),
        ("<ul><li>a<ul><li>b</ul>c<li>d</ul>", "a\n\nb\n\nc\n\nd"),
        ("<h1>a<h2>b</h3>c", "a\n\nb\n\nc"),
        ("\ta\n\xa0 b c\x0c", "a b c"),
        ("a<br>b<br/> <br>c<br></br>d", "a b\n\nc\n\nd"),
        ("a<p", "a"),
        ("a<!-- b", "a"),
        ("a<script>b", "a"),
        ("a<plaintext>b</plaintext>c", "a"),
        ("a</", "a"),
        ("a<", "a<"),
        ("<TABLE><TR><TD>a<TABLE><TR><TD>b</TABLE>c<TD>d</TABLE>e", "a\n\nb\n\nc\n\nd\n\ne"),
    ],
)
def test_markup(html, want):
    assert main_text(html) == want


@given(st.lists(st.sampled_from(
    "<p> </p> <div> </div> <article> </article> <li> <ul> </ul> <td> <table> </table> <a> </a> <br> <b> </b> <h1> "
    "</h1> <span> </span> <form> </form> <!-- --> & &amp; < > x y, \" ' = <p/a=' <script> </script> <body> <select>".split()
), max_size=60))
@settings(max_examples=400, deadline=None)
def test_any_markup_is_read(parts):
    html = " ".join(parts)
    tree = parse(html)
    assert all(parent < n for n, parent in enumerate(tree.parents))
    assert len(tree.texts) == len(tree.nodes) == len(tree.blocks) == len(tree.links)
    text = main_text(html)
    assert text == "\n\n".join(" ".join(t.split()) for t in text.split("\n\n")) and "\n\n\n" not in text


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 60_000 + "x", "<p>" * 60_000, "</p>" * 60_000, "<a href='" * 60_000, "<!--" * 60_000,
        "<" * 200_000, "<b>x" * 60_000, "<li><x>" * 40_000, "<x>" * 40_000 + "</y>" * 40_000, "&amp" * 60_000,
        "<table><tr><td>" * 20_000, "a" * 400_000, "<script>" * 60_000, "<p " + "a=b " * 60_000,
        "<a b=\"" * 30_000 + "'" * 30_000, "<div class=comment><article>" * 20_000, "a, " * 200_000,
    ],
)
def test_long_runs_take_linear_time(html):
    start = time.perf_counter()
    main_text(html)
    assert time.perf_counter() - start < 20


def plain(html):
    """The test tables' pages: one article of headings and paragraphs, in which nothing else stands."""
    inner = re.search(r"<article>(.*?)(</article>|$)", html, re.S)[1]
    blocks = [re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(" ".join(unescape(b).split()) for b in blocks if b.strip())


def test_whole_table_equals_plain(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    found = {r.page_id: r for r in QUERIES["op11_html_extraction"](spark, SF).collect()}
    assert len(found) == len(pages)
    for p in pages:
        r = found[p.page_id]
        assert (r.url, r.text, r.n_chars) == (p.url, plain(p.html), len(plain(p.html)))


def test_frames(spark):
    schema = "page_id long, html string, text string, n_chars int, `a.b` int, row int"
    long = "<p>" + f"{A} " * 20_000
    rows = [(1, None), (2, ""), (None, f"<p>{A}"), (3, f"<p>{A}"), (3, f"<p>{A}"), (4, long), (5, "<p>😀é")]
    df = spark.createDataFrame([(*r, "old", 0, 7, 8) for r in rows], schema)
    out = extract_text(df)
    assert out.columns == ["page_id", "a.b", "row", "text", "n_chars"]
    assert dict(out.dtypes)["n_chars"] == "bigint"
    got = sorted((r.page_id or 0, r.text, r.n_chars, r["a.b"], r.row) for r in out.collect())
    want = [(0, A), (1, ""), (2, ""), (3, A), (3, A), (4, (f"{A} " * 20_000).strip()), (5, "😀é")]
    assert got == [(k, t, len(t), 7, 8) for k, t in want]
    assert extract_text(df.limit(0)).count() == 0
