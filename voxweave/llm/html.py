"""HTML extraction by consensus host paths.

``paths(pages)`` gives (host, path, votes, pages): the winning container path of each
host. ``extract(pages)`` gives (page_id, host, path, used, title, text) of every page.

How. (1) Each page is tokenised; every container (a block element that may hold
running text) gets a score: characters outside links, of text in it and in no container
inside it; a quarter of them where a class names it as boilerplate. The best container votes for its generalised
path: the tags from body down with their classes, where digits in a class are
replaced by '#', and position is left out. (2) Votes are counted by host and path in
Spark, weighted one a page; the winner has the most votes, ties by the path. (3) Each page
is read again with its host's path: text of all elements at that path, in order; a
page that has no such element, or only empty ones though there is text elsewhere, falls back to its own best container (used = 'page'), and
to all text of the body where there is none (used = 'body').

Only counts are shuffled, a row for each host and path of each task. The winners
(one a host) are broadcast where their size allows it, else joined by shuffle.

Text: script, style, template, noscript, head, nav, footer, aside, form and iframe are
left out, but for a form that holds more than half of the page's other text, which is read; block elements end a line; runs of blanks are one space; entities are
decoded. title is that of the title element.

Defined cases. Null html: text, title, path and used null. Empty html or no text: empty text,
used 'host' where the host's path is there (body always is), else 'body'. A null or hostless url counts as host ''. Unclosed and stray tags: an end tag closes
up to the nearest open element of its name, or nothing; p and li are closed by the next one;
any block element closes an open p; bare '<' is text. Elements count at whatever depth they are, in very long pages too. Repeated rows each vote and each give a row. Ties: of paths with equal votes the first by name wins, of containers with equal scores the first. Empty tables
give no rows. Only page_id, url and html are read, so other columns can't clash.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import cut, map_batches, sized

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|iframe|svg|textarea)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S | re.I)
_CLASS = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIP = frozenset("head nav footer aside form button select".split())
_CONTAINERS = frozenset("body main article section div td center blockquote".split())
_BLOCKS = frozenset("address article aside blockquote body br center dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
_SELF_CLOSING = {"p": frozenset(["p"]), "li": frozenset(["li"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "tr": frozenset(["tr", "td", "th"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"])}
_PARAGRAPH = frozenset(["p"])
_SCOPE = frozenset("ul ol table dl select article section div body main".split())
_BOILER = re.compile(r"\b(?:ad|ads|advert\w*|nav\w*|menu|footer|header|sidebar|comment\w*|share|social|promo|banner|cookie\w*|related)\b", re.I)
_DIGITS = re.compile(r"\d+")
_BLANK = re.compile(r"[^\S\n]+")
_LINES = re.compile(r"\s*\n\s*")


def key_of(path: str, begin: tuple[int, int] = (0, 1)) -> tuple[int, int]:
    """Two checksums of a path, which go on from those of what it begins with: a deep element needn't hold its whole path."""
    data = path.encode()
    return zlib.crc32(data, begin[0]), zlib.adler32(data, begin[1])


@dataclass
class Node:
    tag: str
    part: str
    key: tuple[int, int]
    parent: Node | None
    container: Node | None  # the nearest container, itself if it is one
    skip: bool
    boiler: bool
    link: bool
    text: int = 0
    linked: int = 0
    pieces: list[str] = field(default_factory=list)
    forms: tuple[int, ...] = ()  # forms it is in, by their number in the page
    hidden: bool = False  # skipped by something else than a form

    @property
    def path(self) -> str:
        way, at = [], self
        while at is not None:
            way.append(at.part)
            at = at.parent
        return ">".join(reversed(way))


@dataclass
class Page:
    title: str
    containers: list[Node]
    pieces: list[tuple[Node, str]]  # text, and the line ends, with the node they are in


def _part(tag: str, attributes: str) -> tuple[str, str]:
    if "class" not in attributes and "CLASS" not in attributes:
        return tag, ""
    m = _CLASS.search(attributes)
    names = (m[1] or m[2] or m[3] or "").split() if m else []
    return tag + "".join("." + c for c in sorted({_DIGITS.sub("#", x.lower()) for x in names})), " ".join(names)


def parse(source: str, read: frozenset[int] | None = None) -> Page:
    """read: numbers of the forms that are read; by default they are found."""
    inside: dict[int, int] = {}  # characters in each form
    skipped, form = 0, -1
    root = Node("body", "body", key_of("body"), None, None, False, False, False)
    root.container = root
    page = Page("", [root], [])
    stack, at, title, in_title = [root], 0, [], False
    for m in _TOKEN.finditer(source):
        if m.start() > at:
            text = source[at : m.start()]
            if in_title:
                title.append(text)
            elif stack[-1].skip:
                if not stack[-1].hidden:
                    n = len(entities.unescape(text)) - text.count(" ")
                    skipped += n
                    inside |= {k: inside.get(k, 0) + n for k in stack[-1].forms}
            else:
                _add(page, stack[-1], entities.unescape(text) if "&" in text else text)
        at = m.end()
        if m[3] is None:
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if tag == "title":
            in_title = not closing
            continue
        if tag in ("html", "body"):
            continue
        if tag in _BLOCKS and not stack[-1].skip:
            page.pieces.append((stack[-1], "\n"))
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if (ends := _SELF_CLOSING.get(tag, _PARAGRAPH if tag in _BLOCKS else None)) is not None:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    del stack[k:]
                    break
                if stack[k].tag in _SCOPE:
                    break
        if tag in _VOID or m[4].endswith("/"):
            continue
        up = stack[-1]
        part, names = _part(tag, m[4])
        node = Node(tag, part, key_of(">" + part, up.key), up, up.container, up.skip or tag in _SKIP and not (tag == "form" and form + 1 in (read or ())), up.boiler or bool(names and _BOILER.search(names)), up.link or tag == "a")
        form += tag == "form"
        node.forms = (*up.forms, form) if tag == "form" else up.forms
        node.hidden = up.hidden or tag in _SKIP and tag != "form"
        if tag in _CONTAINERS and not node.skip:
            node.container = node
            page.containers.append(node)
        stack.append(node)
    if at < len(source) and not stack[-1].skip and not in_title:
        _add(page, stack[-1], entities.unescape(source[at:]))
    total = skipped + sum(c.text for c in page.containers)
    if read is None and (most := frozenset(k for k, n in inside.items() if 2 * n > total)):
        return parse(source, most)
    page.title = _tidy(entities.unescape("".join(title))).replace("\n", " ")
    return page


def _add(page: Page, node: Node, text: str) -> None:
    page.pieces.append((node, text))
    n = len(text) - text.count(" ")
    node.container.text += n
    if node.link:
        node.container.linked += n


def score(node: Node) -> float:
    """Characters outside links; a quarter of them for what is named as boilerplate."""
    return (node.text - node.linked) * (0.25 if node.boiler else 1.0)


def best(page: Page) -> Node | None:
    """The container of the highest score above 0, the first of several."""
    top = max(page.containers, key=score)
    return top if score(top) > 0 else None


def _tidy(text: str) -> str:
    return _LINES.sub("\n", _BLANK.sub(" ", text)).strip()


def text_at(page: Page, path: str | None) -> str | None:
    """Text of all elements at the path, or None if there is no such element; of the page where path is None."""
    if path is None:
        return _tidy("".join(t for _, t in page.pieces))
    key = key_of(path)
    inside = {id(n) for n in page.containers if n.key == key and n.path == path}
    if not inside:
        return None
    known: dict[int, bool] = {}

    def holds(node: Node) -> bool:
        way, at = [], node
        while at is not None and id(at) not in known and id(at) not in inside:
            way.append(at)
            at = at.parent
        found = at is not None and known.get(id(at), id(at) in inside)
        known.update((id(x), found) for x in way)
        return found

    return _tidy("".join(t for n, t in page.pieces if holds(n)))


def vote(source: str | None) -> str | None:
    if not source:
        return None
    top = best(parse(source))
    return top.path if top else None


def extract_one(source: str | None, path: str | None) -> tuple[str | None, str | None, str | None, str | None]:
    """(path, used, title, text)."""
    if source is None:
        return None, None, None, None
    page = parse(source)
    if path is not None and (text := text_at(page, path)) is not None and (text or not text_at(page, None)):
        return path, "host", page.title, text
    top = best(page)
    if top is not None:
        return top.path, "page", page.title, text_at(page, top.path)
    return None, "body", page.title, text_at(page, None)


def _pages(df: DataFrame) -> DataFrame:
    url = df["url"].cast("string")
    host = F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    return df.select(df["page_id"].cast("long").alias("page_id"), host.alias("host"), df["html"].cast("string").alias("html"))


def paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes, pages)."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([vote(x) for x in batch.column(1).to_pylist()], pa.string())], names=["host", "path"])

    votes = map_batches(_pages(pages).select("host", "html"), "host string, path string", one)
    counted = votes.where("path is not null").groupBy("host", "path").agg(F.count("*").alias("votes"))
    by = Window.partitionBy("host")
    ranked = counted.withColumn("pages", F.sum("votes").over(by)).withColumn("k", F.row_number().over(by.orderBy(F.desc("votes"), "path")))
    return ranked.where("k = 1").select("host", "path", "votes", "pages")


def extract(pages: DataFrame) -> DataFrame:
    winners = cut(paths(pages).select(F.col("host").alias("winner_host"), F.col("path").alias("winner")))
    source = _pages(pages)
    joined = source.join(sized(winners, 300), F.col("host") == F.col("winner_host"), "left").select("page_id", "host", "html", "winner")

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [extract_one(h, w) for h, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([g[k] for g in got], pa.string()) for k in range(4))], names=["page_id", "host", "path", "used", "title", "text"])

    return map_batches(joined, "page_id long, host string, path string, used string, title string, text string", one)
