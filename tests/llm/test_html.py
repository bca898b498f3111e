"""Pages of several layouts, and the given pages against their own markup."""

from __future__ import annotations

import html as H
import re
import time

import pytest
from llm_cases import prose
from surveyflow.llm import html_extract


def sentence(seed, words=30):
    return prose(seed, words).capitalize() + ", " + prose(seed + 500, 5) + "."


A, B, C = sentence(1), sentence(2), sentence(3)
PAGES = {
    "article": (f"<nav><a href=x>Menu</a></nav><article><h1>Title</h1><p>{A}</p><p>{B}<br>more &amp; more</p></article><footer>&copy; us</footer>",
                f"Title\n{A}\n{B} more & more"),
    "divs": (f"<div id=top class='site-header'>Name</div><div class=menu><ul><li><a href=a>A</a><li><a href=b>B</a></ul></div><div class=wrap>"
             f"<div class=post><h1>Title here</h1><div class=body><p>{A}<p>{B}<p>{C}</div></div><div class=sidebar><p>Side note.</p></div></div>"
             "<div class=footer>Imprint</div>", f"Title here\n{A}\n{B}\n{C}"),
    "comments": (f"<main><p>{A}</p><p>{B}</p><section class='comments'><p>I like {C}</p></section></main><aside>Related: {C}</aside>", f"{A}\n{B}"),
    "notices": (f"<div class='cookie-notice'>We use cookies. Accept?</div><div role=alert>Old browser.</div><div class=advertBox>Buy now!</div>"
                f"<article>\n <p> {A}\n\t again </p>\n<form><label>Mail</label><input><button>Go</button></form><ul><li>one, two</li><li>three</li></ul></article>",
                f"{A} again\none, two\nthree"),
    "scripts": (f"<script>if (a < b) document.write('<p>no</p>');</script><style>p{{}}</style><article><p>{A}<!-- no --></p><noscript>no</noscript></article>", A),
    "broken": (f"<article><p><b>{A}<p>{B}</i></div><p>{C}", f"{A}\n{B}\n{C}"),
    "entities": ("<article><p>caf&eacute; &#233;&#x1F600; a&nbsp;b &lt;p&gt;, " + A + "</p></article>", "café é😀 a b <p>, " + A),
    "header in article": (f"<header>Site</header><article><header><h1>Title</h1></header><p>{A}</p></article>", f"Title\n{A}"),
    "empty": ("", ""),
    "menu only": ("<nav><a href=x>Home</a></nav><footer>us</footer>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts(name):
    page, expected = PAGES[name]
    body = f"<!DOCTYPE html><html><head><title>T</title></head><body>{page}</body></html>" if page else page
    assert html_extract.main_text(body) == expected


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = {r["page_id"]: r for r in html_extract.query(spark, sf_dir).collect()}
    for page in pages:
        article = re.search(r"<article>(.*?)(</article>|<footer|$)", page["html"], re.S).group(1)
        article = re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\0", article)))
        blocks = (re.sub(r"\s+", " ", H.unescape(b)).strip() for b in article.split("\0"))
        text = "\n".join(b for b in blocks if b)
        row = found[page["page_id"]]
        assert (row["text"], row["n_chars"], row["url"]) == (text, len(text), page["url"])


def test_edges(spark):
    rows = [(1, None, None, "a"), (None, "u", "<p>" + A, "b"), (2, "u", "", "c"), (2, "u", "", "c"), (3, "u", "<p>" + "word. " * 200_000, "d"), (4, "u", "<" * 5000, "e")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = sorted(((r["page_id"], r["url"], r["n_chars"]) for r in html_extract.extract_pages(df).collect()), key=repr)
    assert found[:3] == [(1, None, 0), (2, "u", 0), (2, "u", 0)] and (3, "u", 6 * 200_000 - 1) in found and (None, "u", len(A)) in found
    assert html_extract.extract_pages(df.limit(0)).count() == 0


def part(words, seeds):
    return "".join(f"<p>{sentence(s, words)}</p>" for s in seeds), "\n".join(sentence(s, words) for s in seeds)


@pytest.mark.parametrize("outer, inner", [("<main>|</main>", "div"), ("<div class=content>|</div>", "section"), ("<div>|</div>", "article")])
def test_a_smaller_body_part_stays(outer, inner):
    (large, a), (small, b) = part(30, range(10, 16)), part(30, range(20, 22))
    body = outer.replace("|", f"<{inner}>{large}</{inner}><{inner}>{small}</{inner}>")
    page = f"<html><body><nav><a href=x>Menu</a></nav>{body}<footer>us</footer></body></html>"
    assert html_extract.main_text(page) == f"{a}\n{b}"


def test_link_heavy_blocks_of_an_article_stay():
    page = f"<article><p>{A}</p><p>{B}</p><p><a href=s>Source: the archive</a></p><ul><li><a href=r>First paper, 1999.</a></li></ul></article>"
    assert html_extract.main_text(page) == f"{A}\n{B}\nSource: the archive\nFirst paper, 1999."
    assert html_extract.main_text("<article><ul><li><a href=r>One paper.</a></li></ul></article>") == "One paper."


@pytest.mark.parametrize("wrap", ["article", "main", "div"])
@pytest.mark.parametrize("name", ["id='related-work'", "id='search-methods'", "class='discussion'"])
def test_sections_of_an_article_stay_whatever_their_name(wrap, name):
    page = f"<{wrap}><p>{A}</p><p>{B}</p><section {name}><h2 id='social-history'>A heading</h2><p>{C}</p></section><div class='share'>Share it</div></{wrap}>"
    assert html_extract.main_text(page) == f"{A}\n{B}\nA heading\n{C}"


def test_a_form_around_the_page():
    page = f"<body><form id=aspnet><div class=menu><a href=x>Home</a></div><div><p>{A}</p><p>{B}</p></div></form><form><p>Search, please.</p></form></body>"
    assert html_extract.main_text(page) == f"{A}\n{B}"


@pytest.mark.parametrize("wrap", ["article", "main", "div"])
@pytest.mark.parametrize("name", ["feedback", "kommentare", "KommentarListe", "werbung", "publicité", "comentarios", "comments", "cookie-hinweis"])
def test_prose_that_a_page_calls_something_else(wrap, name):
    """Comments, adverts and notices go in any of the languages, inside and beside the article, however long they are."""
    long = "".join(f"<p>{sentence(s, 80)}</p>" for s in range(40, 46))
    inside = f"<{wrap}><h1>Title</h1><p>{A}</p><p>{B}</p><div class='{name}'>{long}</div></{wrap}>"
    assert html_extract.main_text(f"<body><div class=menu><a href=x>Home</a></div>{inside}</body>") == f"Title\n{A}\n{B}"
    beside = f"<{wrap}><h1>Title</h1><p>{A}</p><p>{B}</p></{wrap}><div class='{name}'>{long}</div>"
    assert html_extract.main_text(f"<body>{beside}</body>") == f"Title\n{A}\n{B}"


def test_the_ratio_selects_parts_without_names():
    """Short texts without punctuation beside the paragraphs go, headings and lists of the text stay."""
    links = "".join(f"<div><span>Item {k}</span></div>" for k in range(6))
    page = f"<body><div><div><h1>Title</h1></div><p>{A}</p><div>{links}</div><p>{B}</p><ul><li>one<li>two</ul><p>{C}</p></div></body>"
    assert html_extract.main_text(page) == f"Title\n{A}\n{B}\none\ntwo\n{C}"


@pytest.mark.parametrize("opened", ["<div>", "<x-part>", "<section class=comments>", "<ul><li>", "<p><div>", "</b></div>", "<form>"])
def test_deep_and_broken_pages_take_linear_time(opened):
    start = time.perf_counter()
    text = html_extract.main_text("<body>" + opened * 20_000 + f"<p>{A}<p>{B}")
    assert time.perf_counter() - start < 3 and (A in text or "comments" in opened)
