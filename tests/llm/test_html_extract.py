"""Page parts whose names say one thing and whose place says another."""

from __future__ import annotations

import time

import pytest

from ratescope.llm.html_extract import Page, extract

PARTS = ["The great bridge"] + [
    f"Paragraph {i} tells at some length how the bridge was built, by whom, and what it cost the town in those days." for i in range(6)
]
ARTICLE = f"<h1>{PARTS[0]}</h1>" + "".join(f"<p>{p}</p>" for p in PARTS[1:])
SIDE = "<div class='sidebar'><p>Side text that nobody wants in here.</p></div>"
COMMENTS = "<div id='comments'><h1>Readers</h1>" + "".join(
    f"<article class='comment-body'><p>Reader {i} goes on and on about this, at greater length than the article.</p></article>" for i in range(30)
) + "</div>"

WRAPPED = {
    "plain": f"<div class='wrapper'>{ARTICLE}</div>{SIDE}",
    "has": f"<div class='layout has-sidebar'>{ARTICLE}{SIDE}</div>",
    "no": f"<div id='page' class='no-sidebar'>{ARTICLE}</div>",
    "with": f"<div class='wrapper with-banner'>{ARTICLE}</div>{SIDE}",
    "open": f"<div class='entry-content comments-open'>{ARTICLE}</div>{COMMENTS}",
    "page-wide form": f"<form id='aspnetForm'><div>{ARTICLE}</div>{SIDE}<input><select><option>Pick</select></form>",
    "name on a wrapper": f"<div class='right-sidebar'><div class='column'>{ARTICLE}</div>{SIDE}</div>",
    "article in a named wrapper": f"<div class='page-widget'><article>{ARTICLE}</article>{SIDE}{COMMENTS}</div>",
    "longer comments": f"<div class='post'>{ARTICLE}</div>{COMMENTS}<form><p>Your reply</p></form>",
}


@pytest.mark.parametrize("name", WRAPPED)
def test_the_article_is_kept(name):
    assert Page(f"<html><body>{WRAPPED[name]}</body></html>").text([]).split("\n") == PARTS


@pytest.mark.parametrize("body", [
    "<div class='content'></div><div class='sidebar'><h3>More</h3><p>" + "Something else to read. " * 40 + "</p></div>",
    "<div class='cookie-notice'><p>" + "We use cookies. " * 40 + "</p></div>",
    "<div class='site-header header'><h1>Name of the site</h1></div>",
    COMMENTS,
    "", "<div hidden><article><p>Unseen</p></article></div>",
])
def test_a_page_of_surroundings_has_no_text(body):
    assert Page(f"<html><body>{body}</body></html>").text([]) == ""


def test_a_wrapper_of_the_host_is_one_on_its_short_pages(spark):
    long = f"<html><body><div class='page-widget'><div class='body'>{ARTICLE}</div>{SIDE}</div></body></html>"
    short = (
        "<html><body><div class='page-widget'><div class='body'><p>A short piece.</p></div></div>"
        "<div class='teasers'><p>" + "Another story that is told elsewhere. " * 20 + "</p></div></body></html>"
    )
    rows = [(i, f"http://w.example/{i}", long) for i in range(9)] + [(9, "http://w.example/9", short)]
    found = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[0].split("\n") == PARTS
    assert found[9] == "A short piece."


def test_tied_votes_go_to_the_path_with_more_text(spark):
    page = "<html><body><div class='{}'>" + "<p>{}</p>" * 2 + "</div></body></html>"
    rows = [
        (1, "http://t.example/1", page.format("one", "Some words of the first kind", "and more")),
        (2, "http://t.example/2", page.format("two", "A good many more words of the second kind", "and more of them")),
        (3, "http://t.example/3", "<html><body><div class='one'><p>First kind</p></div><div class='two'><p>Second</p></div></body></html>"),
    ]
    found = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[3] in ("First kind", "Second")
    again = {r.page_id: r.text for r in extract(spark.createDataFrame(rows[::-1], "page_id long, url string, html string").repartition(3)).collect()}
    assert again == found


def test_very_long_and_broken_pages_are_read_whole():
    long = "<article>" + "".join(f"<p>Paragraph number {i} of many.</p>" for i in range(50_000)) + "</article>"
    assert Page(long).text([]).count("\n") == 49_999
    began = time.monotonic()
    assert Page("<svg>" * 100_000 + "<p>Last words</p>").text([]) == "Last words"
    assert time.monotonic() - began < 20
