"""Pages whose article lies where an open head or a marked wrapper would hide it."""

import pytest

from spindrift.llm.html_extract import Page

STORY = "<p>" + "A plain sentence of the story. " * 20 + "</p>"
TEXT = " ".join(("A plain sentence of the story. " * 20).split())


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><body><article>{STORY}</article></body></html>",
    f"<html><head><meta charset=utf-8><link rel=x><script>var a;</script><style>p</style><article>{STORY}</article>",
    f"<html><head><title>T</title>{STORY[3:-4]}",
])
def test_open_head_ends_at_content(page):
    assert Page(page).text(None) == TEXT


def test_closed_head_is_dropped():
    assert Page(f"<html><head><title>T</title>\n</head><body>{STORY}</body>").text(None) == TEXT


@pytest.mark.parametrize("page", [
    f"<div class='layout has-sidebar'><article>{STORY}</article><div class=sidebar>side</div></div>",
    f"<div class='layout has-sidebar'><div class=content>{STORY}</div><div class=sidebar>side</div></div>",
    f"<div id='page' class='no-sidebar'>{STORY}</div>",
    f"<article class='post comments-open'>{STORY}</article>",
    f"<div class='wrap widget'><article>{STORY}</article><div class=related><article>other</article></div></div>",
    f"<div class='page menu'><main>{STORY}</main><div id=comments><p>{'nice ' * 900}</p></div></div>",
    f"<div id='search'><div class=content>{STORY}</div></div><div class='cookie'>we use them</div>",
    f"<div class='wrap rail'><div class='box overlay'><article>{STORY}</article></div></div>",
])
def test_marked_wrapper_keeps_the_article(page):
    assert Page(f"<html><body>{page}</body></html>").text(None) == TEXT


@pytest.mark.parametrize("part", [
    "<div class=sidebar>side</div>", "<div class=related><article>" + "other words " * 300 + "</article></div>", "<article class=comment><p>" + "nice " * 900 + "</p></article>",
    "<div id=comments><article class=comment-body><p>" + "nice " * 900 + "</p></article></div>", "<nav><article>menu</article></nav>", "<p class=hidden>x</p>",
])
def test_marked_parts_beside_an_article_go(part):
    assert Page(f"<html><body><article>{STORY}</article>{part}</body></html>").text(None) == TEXT
    assert Page(f"<html><body><article>{STORY}{part}</article></body></html>").text(None) == TEXT
