"""Main text of pages of several layouts, and broken markup."""

import html
import re

import pytest

from tests.conftest import SF01
from tidewater.llm.catalog import QUERIES
from tidewater.llm.html_text import extract, main_text

LONG = "This paragraph has more than enough words to be taken for the text of an article, really."


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


READER = "I read this with much interest and would like to add that I do not agree with it at all."
CASES = {
    "class words inside the article": (
        "<article><h1>Title</h1>"
        + "".join(
            f"<div class='{c}'><p>{LONG} {c}</p></div>"
            for c in "social-studies skip-lazy widget-text ad-hoc alert-history related-work search-and-rescue discussion "
            "overlay-map notice-board".split()
        )
        + "</article>",
        "Title\n"
        + "\n".join(
            f"{LONG} {c}"
            for c in "social-studies skip-lazy widget-text ad-hoc alert-history related-work search-and-rescue discussion "
            "overlay-map notice-board".split()
        ),
    ),
    "comments that are articles": (
        f"<main><article><h1>Title</h1><p>{LONG}</p></article><section id=comments class=comments><h2>Comments</h2>"
        f"<article class=comment><p>{READER}</p></article><article class='comment'><p>{READER}</p></article></section></main>",
        f"Title\n{LONG}",
    ),
    "a paragraph that is an advert": (f"<article><p>{LONG}</p><p class=advert>{READER}</p></article>", LONG),
    "a paragraph that is a notice": (f"<article><p class='cookie-notice'>{READER}</p><p>{LONG}</p></article>", LONG),
    "an article that is an advert": (f"<main><article><p>{LONG}</p></article><article class=advert><p>{READER}</p></article></main>", LONG),
    "teaser articles of related pages": (
        f"<main><article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></article><div class=related>"
        f"<article><h3>Other</h3><p>{READER}</p></article></div></main>",
        f"Title\n{LONG}\n{LONG}",
    ),
    "links in an element with a hint in its name": (
        f"<article><p>{LONG}</p><div class='share-this'><p><a href=/a>Send it to a friend or to somebody else whom you know</a></p></div></article>",
        LONG,
    ),
    "no article element": (
        f"<header><h1>Site</h1></header><div id=content><h1>Title</h1><p>{LONG}</p><p>Of.</p><p>{LONG}</p></div>"
        "<div class='sidebar'><p>Some other things that are nice to read as well.</p></div><footer>(c)</footer>",
        f"Title\n{LONG}\nOf.\n{LONG}",
    ),
    "tiny article beside a larger advert": (f"<div class=ad>{LONG}</div><article><h1>Ha.</h1><p>Ha.</article>", "Ha.\nHa."),
    "comments inside the article": (
        f"<main><article><p>{LONG}</p><section id=comments><p>{LONG} said a reader.</p></section></article></main>",
        LONG,
    ),
    "article header and footer": (
        f"<article><header><h1>Title</h1></header><p>{LONG}</p><footer>Filed under</footer></article>",
        f"Title\n{LONG}",
    ),
    "teasers in aside": (f"<article><p>{LONG}</p></article><aside><article><p>{LONG} {LONG}</p></article></aside>", LONG),
    "wrapper named after its sidebar": (f"<div class='with-sidebar menu'><article><p>{LONG}</p></article></div>", LONG),
    "references and space": ("<article><p> a&nbsp;&amp;\n\t b &#233; &bogus; <br>c</p></article>", "a & b é &bogus; c"),
    "menu of links in the article": (
        f"<article><p>{LONG}</p><ul>" + "<li><a href=#>Link text</a></li>" * 4 + "</ul><p>End.</p></article>",
        f"{LONG}\nEnd.",
    ),
    "hidden, form, script": (
        f"<article><p hidden>x</p><p style='display: none'>y</p><form>z<input></form><script>var a='</p>';</script><p>{LONG}</p></article>",
        LONG,
    ),
    "table, list, quote": (
        f"<article><p>{LONG}</p><table><tr><td>a<td>b</table><ul><li>one<li>two</ul><blockquote>q</blockquote></article>",
        f"{LONG}\na\nb\none\ntwo\nq",
    ),
    "cookie notice and dialog": (f"<div role=dialog><p>{LONG}</p></div><div id='cookie-bar'>{LONG}</div><article>{LONG} 2</article>", f"{LONG} 2"),
}


@pytest.mark.parametrize("name", CASES)
def test_layouts(name):
    body, want = CASES[name]
    assert main_text(page(body)) == want


BROKEN = ["", None, "plain words", "<p>", "</p></div>", "<article><p>a<b>b</article>c", "<!-- open", "<a <b <c>x", "&#xfffffff;&#0;", "<p>x" * 20_000, "<div>" * 5_000 + "x"]


@pytest.mark.parametrize("given", BROKEN)
def test_broken_markup_never_fails(given):
    assert isinstance(main_text(given), str)


def test_only_left_out_elements():
    assert main_text(page("<nav>a</nav><footer>b</footer>")) == ""


def test_table_and_odd_rows(spark):
    import duckdb

    rows = duckdb.connect().execute(f"SELECT page_id, html FROM '{SF01}/pages.parquet'").fetchall()
    found = {r.page_id: r for r in QUERIES["op8_html_text"](spark, SF01).collect()}
    for page_id, given in rows:
        parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", given, re.S)[1])
        blocks = (" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in parts)
        assert found[page_id].text == "\n".join(x for x in blocks if x)
        assert found[page_id].n_chars == len(found[page_id].text)
    odd = spark.createDataFrame([(1, None, None, "t"), (1, "u", "<p>x</p>", "t"), (1, "u", "<p>x</p>", "t"), (None, "u", "", "t")], "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in extract(odd).collect()) == [(0, "", 0), (1, "", 0), (1, "x", 1), (1, "x", 1)]
    assert extract(odd.limit(0)).count() == 0


WHOLE = {
    "headline beside the body": (f"<div id=content><h1>Title</h1><div class=body><p>{LONG}</p><p>{LONG}</p></div></div><footer>(c)</footer>", f"Title\n{LONG}\n{LONG}"),
    "lead in a sibling": (
        f"<div id=content><div class=lead><p>{LONG}</p></div><div class=body>" + f"<p>{LONG * 5}</p>" * 4 + "</div></div>",
        "\n".join([LONG] + [LONG * 5] * 4),
    ),
    "heading, lead and section beside the article": (
        f"<main><h1>Title</h1><p>{LONG}</p><article><p>{LONG * 5}</p><p>{LONG * 5}</p></article><section><h2>More</h2><p>{LONG}</p></section></main>",
        f"Title\n{LONG}\n{LONG * 5}\n{LONG * 5}\nMore\n{LONG}",
    ),
    "heading before the article": (f"<h1>Title</h1><p>Lead.</p><article><p>{LONG}</p></article><div>All rights.</div>", f"Title\nLead.\n{LONG}"),
    "two articles": (f"<article><h1>A</h1><p>{LONG}</p></article><article><p>{LONG * 3}</p></article>", f"A\n{LONG}\n{LONG * 3}"),
    "linked references": (
        f"<article><p>{LONG}</p><ol>" + "".join(f"<li><a href='https://x.example/{i}'>Source {i}</a></li>" for i in range(4)) + "</ol></article>",
        LONG + "".join(f"\nSource {i}" for i in range(4)),
    ),
    "beside without content": (f"<div><p>(c) us</p></div><div><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></div>", f"Title\n{LONG}\n{LONG}"),
}


@pytest.mark.parametrize("name", WHOLE)
def test_nothing_of_the_article_is_lost(name):
    body, want = WHOLE[name]
    assert main_text(page(body)) == want
