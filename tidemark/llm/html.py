"""Main text of web pages by consensus paths of their hosts.

Each page's containers are scored; pages vote, in Spark, for the generalised tag-class path of
their best container; each page is then extracted anew from the containers on its host's winning
paths, or from its own best one where the page has none of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import is_small
from .common import stored

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math select xmp noembed noframes".split())
SKIPPED = frozenset("head nav header footer aside form button dialog menu object canvas audio video label fieldset".split()) | RAW
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
CONTAINERS = frozenset("article main section div td body blockquote center".split())
#: Elements that end an open paragraph, and those that a sibling of the given kinds ends.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "tbody", "thead"), "tfoot": ("tr", "td", "th", "tbody", "thead")}
#: Words of a class, id or role that mark what is no main text, and those that mark main text.
NOISE = re.compile(r"(?:^|[-_\s])(?:ads?|adv\w*|advert\w*|banner\w*|breadcrumbs?|byline|comments?|comment\w*|respond|replies|disqus|consent|cookies?|cookie\w*|footer\w*|header|masthead|gdpr|hidden|login|menu\w*|modal|nav|nav\w*|navigation|newsletter\w*|notice\w*|notification\w*|pagination|pager|popup|promo\w*|related\w*|recommend\w*|rail|search\w*|share|sharing|sidebar\w*|side|signup|social\w*|sponsor\w*|subscribe\w*|tags?|toolbar|toc|widget\w*|complementary|contentinfo|alert\w*|paywall)(?:$|[-_\s])", re.I)
#: Names that hold a word of ``NOISE`` but tell of a layout, or of the head of the main text.
HARMLESS = re.compile(r"(?<![^-_\s])(?:(?:with|has|no|without)[-_]+(?:(?:left|right)[-_]+)?[^-_\s]+|(?:article|content|entry|main|page|post|story)[-_]+header)(?![^-_\s])", re.I)
MAIN = re.compile(r"article|body|content|entry|main|post|story|text", re.I)

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
#: Parts that a host is dealt over where the hosts are too many to broadcast.
SALTS = 32
#: Share of the page's unlinked text from which on an element is not hidden for its name alone, and
#: the share that will do for one which has all the page's headings, articles and main elements.
MOST, MOST_OF_MAIN = 0.9, 0.5
LANDMARKS = frozenset(("h1", "article", "main"))
#: The path of the body that a page leaves out.
IMPLIED = "implied body"
#: Characters beyond which a path is replaced by its hash, which further names are added to.
LONGEST_PATH = 400
_SPACE = re.compile(r"\s+")
_NUMBER = re.compile(r"\d+")


class Node:
    """A container: its path, its blocks of text in page order, and what is inside it."""

    __slots__ = ("path", "first", "last", "before", "chars", "links", "paragraphs", "weight", "depth")

    def __init__(self, path: str, first: int, before: tuple[int, int, int], weight: float, depth: int):
        self.path, self.first, self.last, self.before, self.weight, self.depth = path, first, first, before, weight, depth
        self.chars = self.links = self.paragraphs = 0


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)} if text else {}


def _generalised(tag: str, attrs: dict[str, str]) -> str:
    names = sorted({_NUMBER.sub("0", c.lower()) for c in attrs.get("class", "").split()})
    return ".".join([tag, *names])


def _below(above: str, name: str) -> str:
    """The path of an element ``name`` right below ``above``: different ones stay different at any depth."""
    path = f"{above}>{name}" if above else name
    return path if len(path) <= LONGEST_PATH else "~" + blake2b(path.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def parse(html: str) -> tuple[list[str], list[Node]]:
    """The page's blocks of text, without what is marked as no main text, and its containers.

    A name alone does not hide an element that has most of the page's unlinked text; where
    nothing would be left, no name hides anything."""
    blocks, nodes, seen = _parsed(html, frozenset())
    shown = seen.pop(-1)[1]
    if not seen or blocks and max(size for size, _, _ in seen.values()) < 0.9 * shown:
        return blocks, nodes  # none of the hidden elements can have half of the text
    all_blocks, all_nodes, seen = _parsed(html, None)
    _, total, marks = seen.pop(-1)
    kept = frozenset(at for at, (_, own, inside) in seen.items() if own > 0 and own >= (MOST_OF_MAIN if marks and inside == marks else MOST) * total)
    if kept:
        blocks, nodes, _ = _parsed(html, kept)
    return (blocks, nodes) if blocks else (all_blocks, all_nodes)


def _parsed(html: str, kept: frozenset[int] | None) -> tuple[list[str], list[Node], dict[int, tuple[int, int, int]]]:
    """Blocks, containers, and by its place each element with a name of ``NOISE``: its size in the
    page, its unlinked text, and how many of ``LANDMARKS`` it has (-1: the same of the page). Such
    elements are hidden, but not those at the places ``kept``, and none if that is None.

    A block is the text between the borders of elements that are not inline; white space in it
    becomes one blank."""
    seen: dict[int, tuple[int, int, int]] = {}
    blocks: list[str] = []
    open_text: list[str] = []
    stack: list[tuple] = []  # (tag, path, skipped, node, depth, place and counts before if named as noise)
    nodes: list[Node] = []
    opened: Counter[str] = Counter()
    in_link = linked = chars = links = paragraphs = marks = 0

    def close_block():
        nonlocal linked, chars, links, paragraphs
        text = _SPACE.sub(" ", unescape("".join(open_text))).strip() if open_text else ""
        open_text.clear()
        if text:
            blocks.append(text)
            chars, links = chars + len(text), links + linked
            paragraphs += len(text) > 25 and linked * 2 < len(text)
        linked = 0

    def pop():
        nonlocal in_link
        tag, _, _, node, _, noise = stack.pop()
        opened[tag] -= 1
        if tag == "a":
            in_link -= 1
        if noise is not None:
            place, text, inside = noise
            seen[place] = at - place, chars - links - text, marks - inside
        if node is not None:
            node.last = len(blocks)
            node.chars, node.links, node.paragraphs = (now - then for now, then in zip((chars, links, paragraphs), node.before))

    def skipped():
        return bool(stack) and stack[-1][2]

    at = 0
    while True:
        m = TOKEN.search(html, at)
        end = m.start() if m else len(html)
        if end > at and not skipped():
            text = html[at:end]
            open_text.append(text)
            if in_link:
                linked += len(text.strip())
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA[") and not skipped():
                open_text.append(m[0][9:].removesuffix("]]>"))
            continue
        if m[1]:
            if opened[tag]:
                if tag not in INLINE and not skipped():
                    close_block()
                while stack:
                    was = stack[-1][0]
                    if was not in INLINE and not skipped():
                        close_block()
                    pop()
                    if was == tag:
                        break
            elif tag == "p" and not skipped():
                close_block()
            continue
        if tag in RAW:
            # nothing inside is markup
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            if not m[0].endswith("/>") or tag not in ("svg", "math"):
                at = close.end() if close else len(html)
            if tag in ("svg", "math", "select", "textarea", "iframe") or skipped():
                continue
            close_block() if tag not in INLINE else None
            continue
        if tag == "br":
            if not skipped():
                open_text.append(" ")
            continue
        if tag in ENDS_P:
            k = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p") if opened["p"] else -1
            if k >= 0 and not any(stack[i][0] in ("table", "button", "object") for i in range(k, len(stack))):
                if not skipped():
                    close_block()
                while len(stack) > k:
                    pop()
        elif tag in ENDED_BY:
            borders = ("ul", "ol", "dl", "table", "menu")
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in ENDED_BY[tag] or stack[i][0] in borders), -1)
            if k >= 0 and stack[k][0] not in borders:
                if not skipped():
                    close_block()
                while len(stack) > k:
                    pop()
        if tag not in INLINE and not skipped():
            close_block()
        if tag in VOID:
            continue
        attrs = _attributes(m[3])
        above = stack[-1][1] if stack else ""
        path = above if tag in INLINE else _below(above, _generalised(tag, attrs))
        depth = (stack[-1][4] if stack else 0) + (tag not in INLINE)
        named = " ".join(attrs.get(k, "") for k in ("class", "id", "role"))
        hide = skipped() or tag in SKIPPED and not (tag == "header" and opened["article"]) or "hidden" in attrs or attrs.get("aria-hidden") == "true"
        hide = hide or "display:none" in attrs.get("style", "").replace(" ", "")
        noise = None
        if not hide and tag not in ("html", "body", "article", "main") and named.strip() and NOISE.search(HARMLESS.sub(" ", named)):
            noise = m.start(), chars - links, marks
            hide = kept is not None and m.start() not in kept
        marks += tag in LANDMARKS and not hide
        node = None
        if tag in CONTAINERS and not hide:
            node = Node(path, len(blocks), (chars, links, paragraphs), 2.0 if tag in ("article", "main") else 0.9 if tag == "body" else 1.3 if MAIN.search(named) else 1.0, depth)
            nodes.append(node)
        stack.append((tag, path, hide, node, depth, noise))
        opened[tag] += 1
        if tag == "a":
            in_link += 1
    close_block()
    at = len(html)
    while stack:
        pop()
    if blocks and not any(n.path.rpartition(">")[2].split(".")[0] == "body" and n.first == 0 and n.last == len(blocks) for n in nodes):
        body = Node(IMPLIED, 0, (0, 0, 0), 0.9, 0)
        body.last, body.chars, body.links, body.paragraphs = len(blocks), chars, links, paragraphs
        nodes.append(body)
    seen[-1] = len(html), chars - links, marks
    return blocks, nodes, seen


def score(node: Node) -> float:
    """Text that is not in links, more for paragraphs and for names of main text."""
    return (node.chars - 1.5 * node.links + 20 * node.paragraphs) * node.weight


def best(nodes: list[Node]) -> Node | None:
    """The container with text of the best score; of equal ones the innermost."""
    return max((n for n in nodes if n.chars), key=lambda n: (score(n), n.depth), default=None)


def extract(html: str | None, paths: frozenset[str] | set[str]) -> str:
    """Main text: the blocks of the outermost containers on ``paths`` (of those that score a fifth
    of the best of them), else of the best container."""
    blocks, nodes = parse(html or "")
    won = [n for n in nodes if n.path in paths and n.chars]
    if won:
        least = max(map(score, won)) / 5
        won = [n for n in won if score(n) >= least] or won
    else:
        one = best(nodes)
        won = [one] if one is not None else []
    out, end = [], 0
    for n in sorted(won, key=lambda n: n.first):
        out += blocks[max(n.first, end):n.last]
        end = max(end, n.last)
    return "\n\n".join(out)


def host_of(url: str) -> F.Column:
    """The host of an address in lower case; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[tuple[str, str], int] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
            one = best(parse(html.as_py() or "")[1])
            if one is not None:
                found[host, one.path] = found.get((host, one.path), 0) + 1
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found]), pa.array([p for _, p in found]), pa.array(list(found.values()), pa.int64())], ["host", "path", "votes"])


def winning_paths(pages: DataFrame, share: float = 0.2) -> DataFrame:
    """(host, paths): for each host the paths with at least ``share`` of its votes, one for each
    layout and never more than 1 / ``share``. Votes are summed by task first, so a host with a
    third of the pages is no hot spot."""
    votes = pages.select(host_of("url").alias("host"), "html").mapInArrow(_votes, "host string, path string, votes long")
    votes = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    total = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    return votes.join(total, "host").where(F.col("votes") >= share * F.col("total")).groupBy("host").agg(F.collect_set("path").alias("paths"))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(h.as_py(), frozenset(p or ())) for h, p in zip(batch.column("html"), batch.column("paths").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each of ``pages`` (page_id, url, html).

    A null or empty html gives an empty text; pages without a host vote as one host. Repeated
    rows are extracted each for itself; other columns are left aside; no rows give none.
    A host has at most five paths. Their table is broadcast if a count proves it small; a larger
    one is joined with each host dealt over ``SALTS`` parts, so that no host fills a task."""
    paths = stored(winning_paths(pages), "host-paths")
    rows = pages.select("page_id", "url", "html", host_of("url").alias("host"))
    if is_small(paths):
        rows = rows.join(F.broadcast(paths), "host", "left")
    else:
        salted = paths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("url", F.octet_length("html")), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    return rows.select("page_id", "url", "html", "paths").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
