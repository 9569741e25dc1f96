"""Pages that once lost text or let markup through, and generated pages beside a plain tree."""

import html
import random
import time

import pytest

from spindrift.llm.html_extract import Page

LONG = "A plain sentence of the story goes on here. " * 8


@pytest.mark.parametrize("page, want", [
    ('<p>See <img alt="1 < 2" src=x> more</p>', "See more"),
    ('<article data-h="<p>Hello</p>">Body here</article>', "Body here"),
    ("<p title='a > b'>one</p><p data-x='<b>'>two</p>", "one two"),
    ('<p title="abc>text</p><p>x</p>', "text x"),  # never closed: the tag ends at >
    ('<p class="a"">t</p><p class="b">u</p>', "t u"),  # a quote outside of a value quotes nothing
    ("<p>5 < 6 and <b>x</b></p>", "5 < 6 and x"),
    ("<p>AT&<b>amp;</b>T &amp; &lt;b&gt;</p>", "AT&amp;T & <b>"),
])
def test_markup_stays_out(page, want):
    assert Page(page).text(None) == want


@pytest.mark.parametrize("part", [
    '<section id="share-prices"><p>Prices rose.</p></section>', '<p id="notice-of-default">It was sent.</p>', '<table class="form"><tr><td>cell</td></tr></table>',
    '<p class="search">They searched.</p>', '<h2 id="comments-on-the-law">Heading</h2>', '<div id="menu-prices-in-rome"><p>Dear.</p></div>',
])
def test_subjects_are_no_marks(part):
    made = Page(f"<article><p>{LONG}</p>{part}<p>{LONG}</p></article>").text(None)
    assert Page(part.replace(" id=", " x=").replace(" class=", " y=")).text(None) in made


@pytest.mark.parametrize("part", [
    '<div id="ad-slot-2">Buy</div>', '<div class="share-buttons">Share</div>', '<p class="advert">Buy</p>', '<ul class="breadcrumbs"><li>Home</li></ul>', '<div id="related-posts">Other</div>',
    '<p class="hidden">x</p>', '<div id="newsletter">Join</div>',
])
def test_marked_parts_go(part):
    assert Page(f"<article><p>{LONG}</p>{part}<p>{LONG}</p></article>").text(None) == " ".join((LONG * 2).split())


def test_siblings_of_a_story_stay():
    first, second = "First part of the story, at length. " * 18, "Second part of the story as well. " * 9
    for page in (f"<body><div class=a><p>{first}</p></div><div class=b><p>{second}</p></div></body>", f"<body><div class=a><p>{first}</p></div><p>{second}</p></body>"):
        assert Page(page).text(None) == " ".join((first + second).split())
    teaser = "<article>" + "Teaser text. " * 15 + "</article>"
    assert " ".join((LONG * 2).split()) in Page(f"<body>{teaser}<p>{LONG}</p><p>{LONG}</p></body>").text(None)
    links = "".join(f"<li>item {i}</li>" for i in range(40))  # short blocks beside the story
    assert Page(f"<body><div class=a><p>{first}</p></div><div class=b><ul>{links}</ul></div></body>").text(None) == " ".join(first.split())


@pytest.mark.parametrize("page", [
    lambda n: "<div>" * n + "x", lambda n: "<span>" * n + "</b>" * n + "x", lambda n: "<li>" + "<div>" * n + "<li>" * n, lambda n: "<ul>" * n + "<p>" * n,
    lambda n: "<nav>" + "<span>" * n + "<i>" * n, lambda n: "<div class=c>" * n + "text", lambda n: "<article>" * n + "x",
])
def test_deep_nesting_takes_linear_time(page):
    def seconds(n):
        started = time.process_time()
        Page(page(n)).text(">".join(["div.c"] * 6))
        return time.process_time() - started

    assert seconds(40_000) < 12 * max(seconds(10_000), 0.02)


def generated(rng):
    """A page and the text of its article, from a tree of known parts."""
    words = lambda n: " ".join(rng.choice(["sun", "river", "a & b", "x < y", "café", "stone"]) for _ in range(n))
    blocks = [words(rng.randint(20, 60)) for _ in range(rng.randint(3, 9))]
    body, want = [], []
    for i, block in enumerate(blocks):
        tag = rng.choice(["p", "p", "p", "blockquote", "h2"])
        inside = html.escape(block, quote=False)
        if rng.random() < 0.3:
            cut = inside.find(" ")
            inside = f'<b title="{i} < {i + 1}">{inside[:cut]}</b>{inside[cut:]}<!-- note > here -->'
        body.append(f"<{tag}>{inside}</{tag}>" if rng.random() < 0.8 or tag != "p" else f"<p>{inside}")
        want.append(block)
        if rng.random() < 0.3:
            body.append(rng.choice(['<div class="ad-unit">Buy now</div>', "<script>if (a < b) { x = '<p>no</p>'; }</script>", '<aside>aside</aside>', "<form><input><p>mail</p></form>"]))
    article = rng.choice(["<article>{}</article>", '<div class="post-body">{}</div>', "<main><div>{}</div></main>"]).format("\n".join(body))
    around = '<nav><ul><li><a href="/">Home</a></li></ul></nav>', '<footer>All rights reserved</footer>', '<div class="sidebar"><p>More to read</p></div>', '<div id="comments"><p>' + words(30) + "</p></div>"
    parts = [around[0], article, *rng.sample(around[1:], rng.randint(0, 3))]
    return f"<html><head><title>t</title></head><body>{''.join(parts)}</body></html>", " ".join(want)


def test_generated_pages():
    rng = random.Random(11)
    for _ in range(400):
        page, want = generated(rng)
        assert Page(page).text(None) == want, page
