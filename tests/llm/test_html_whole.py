"""Pages without a body element, and main text inside elements whose names mark noise."""

import pytest

from tidemark.llm.html import extract

LONG = "A sentence with quite a few words in it, so that it counts as a paragraph of the article. "
TEXT = LONG.strip()


@pytest.mark.parametrize("page,want", [
    (f"<h1>T</h1><p>{LONG}</p><div></div>", ["T", TEXT]),
    (f"<!doctype html><title>t</title><h1>T</h1><p>{LONG}</p><div>note</div>", ["T", TEXT, "note"]),
    (f"<html><h1>T</h1><p>{LONG}</p><div>note</div></html>", ["T", TEXT, "note"]),
    (f"<body><p>note</p></body><p>{LONG}</p>", ["note", TEXT]),
    ("<a href=x>one link</a><div></div>", ["one link"]),
    (f"<body><div class='content with-sidebar'><h1>T</h1><p>{LONG}</p></div><div class='sidebar'><p>side</p></div></body>", ["T", TEXT]),
    (f"<body><div class='page has-sidebar'><article><h1>T</h1><p>{LONG * 2}</p></article><div class='sidebar'><p>side</p></div></div><p>{LONG}</p></body>", ["T", (LONG * 2).strip()]),
    (f"<body><div class='search-results'><h1>T</h1><p>{LONG * 3}</p></div><div class='other'><p>{LONG}</p></div></body>", ["T", (LONG * 3).strip(), TEXT]),
    (f"<body><div class='search-results'><p>{LONG}</p></div></body>", [TEXT]),
    (f"<body><div class='notice-board'><p>{LONG}</p></div><div class='sidebar'><p>{LONG}</p></div></body>", [TEXT, TEXT]),
    (f"<article><div class='article-header'><h1>T</h1></div><p>{LONG}</p><div class='comments'><p>{LONG * 2}</p></div></article>", ["T", TEXT]),
    (f"<body><div id='header'><h1>Site</h1></div><div id='content'><p>{LONG}</p></div></body>", [TEXT]),
    (f"<body><div class='a'><h1>T</h1><p>{LONG}</p></div><div class='comments'><p>{LONG * 4}</p></div></body>", ["T", TEXT]),
])
def test_nothing_lost(page, want):
    assert extract(page, frozenset()) == "\n\n".join(want)
