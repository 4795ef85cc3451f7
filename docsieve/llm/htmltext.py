"""Main text of web pages, by host-wide consensus on where the text is.

Each page's containers are scored by the text that they hold outside menus, headers, footers and
the like. The best one votes for its path, the tags and classes above it without numbers. Spark
counts the votes of each host, and pages are then extracted from the host's winning path; a page
without that path uses its own best container.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.llm.common import shipped, whole, written
from docsieve.llm.urls import host

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template svg iframe textarea title object xmp noembed noframes annotation annotation-xml".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var center wbr img br picture source "
    "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup mover munder munderover mtable mtr mtd "
    "mstyle mpadded mphantom mfenced menclose annotation annotation-xml".split()
)
_DROPPED = frozenset("nav footer aside button select dialog menu input option datalist head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
_CLASSES = frozenset(
    "nav navbar navigation menu header footer sidebar aside notice notices cookie cookies consent banner alert ad ads "
    "adv advert adverts advertisement advertising sponsor sponsored promo promotion comment comments disqus replies "
    "respond share sharing social related breadcrumb breadcrumbs newsletter subscribe popup modal overlay widget "
    "toolbar pagination pager masthead topbar copyright hidden".split()
)
# Words that may stand beside those in a compound name such as site-header or sidebar-1. Others, as in has-sidebar or
# content-with-menu, speak of a layout.
_BESIDE = frozenset(
    "site page main top bottom left right global primary secondary mobile desktop box bar block list item items area "
    "section container wrap wrapper inner link links button buttons icons panel group form title posts".split()
)
_OF_ARTICLE = frozenset("article entry post".split())
_NO_ARTICLE = frozenset("comment comments ad ads advert teaser related".split())
# What stands beside an article, however long it is.
_BESIDES_ARTICLE = _NO_ARTICLE | frozenset("disqus replies respond".split())
_CONTAINERS = frozenset("div section article main td center span dd".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
_GOOD = frozenset("article content post entry story main body text".split())
# Elements that the start of another one ends.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
# As the HTML tokenizer reads them: a quote opens a value only right after "=", elsewhere it belongs to a name.
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
# Attributes up to the tag's end. Nothing is read twice but a quote that never closes; that one opens nothing.
_ATTRIBUTES = re.compile(r"""(?:[\s/]++|[^\s/>][^\s/>=]*+\s*+(?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+)*+""")
_MAY_HIDE = re.compile("class|id|hidden|role|style", re.I)
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")


class _Node:
    """An element. ``hidden``: its text is left out in any case; ``named``: by its name, unless the article is inside
    (1), or only where no article is outside either (2). ``full`` and ``told`` are the lengths of the text that is not
    hidden, all of it and that in articles; ``size`` is that of the text kept, ``prose`` that of kept headings and
    paragraphs that lie in no smaller container. ``key`` is a hash of the path."""

    __slots__ = ("tag", "name", "key", "parent", "hidden", "named", "dropped", "full", "told", "size", "prose", "bonus", "inside")

    def __init__(self, tag: str, name: str, parent: _Node | None, hidden: bool, named: int, bonus: float):
        self.tag, self.name, self.parent, self.hidden, self.named, self.bonus = tag, name, parent, hidden, named, bonus
        self.key = zlib.crc32(f"/{name}".encode(), parent.key) if parent else 0
        self.dropped, self.full, self.told, self.size, self.prose, self.inside = hidden, 0, 0, 0, 0, False

    @property
    def path(self) -> str:
        """The names from the top down; put together on demand, since they grow with the depth."""
        names, node = [], self
        while node.parent is not None:
            names.append(node.name)
            node = node.parent
        return "".join(f"/{n}" for n in reversed(names))

    def container(self) -> _Node:
        """The next element upwards that may hold an article."""
        node = self
        while node.parent is not None and node.tag not in _CONTAINERS and node.tag != "body":
            node = node.parent
        return node


def _tags(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) of a page: text, start and end; comments and raw text are left out."""
    at, end = 0, len(page)
    while at < end:
        start = page.find("<", at)
        if start < 0:
            yield "text", page[at:], ""
            return
        following = page[start + 1 : start + 2]
        if following == "!" or following == "?":
            if start > at:
                yield "text", page[at:start], ""
            if page.startswith(("<!-->", "<!--->"), start):
                at = page.find(">", start) + 1
            elif page.startswith(("<!--", "<![CDATA["), start):
                mark = "-->" if page[start + 2] == "-" else "]]>"
                close = page.find(mark, start + 4)
                at = end if close < 0 else close + 3
            else:
                close = page.find(">", start)
                at = end if close < 0 else close + 1
            continue
        closing = following == "/"
        name = _NAME.match(page, start + 1 + closing)
        if not name:
            yield "text", page[at : start + 1], ""
            at = start + 1
            continue
        if start > at:
            yield "text", page[at:start], ""
        tag = name.group().lower()
        close = _ATTRIBUTES.match(page, name.end()).end()
        if close == end:
            return
        at = close + 1
        if closing:
            yield "end", tag, ""
            continue
        attributes = page[name.end() : close]
        yield "start", tag, attributes
        if tag in _RAW and not attributes.endswith("/"):
            close = re.compile(f"</{tag}[\\s/>]", re.I).search(page, at)
            if close:
                after = page.find(">", close.start())
                at = end if after < 0 else after + 1
            else:
                at = end
            yield "end", tag, ""


def _left_out(token: str) -> set[str]:
    """The words for which a class or id as a whole names something beside the text; none if it does not."""
    parts = {w.lower() for w in _SPLIT.split(token) if w}
    if "hidden" in parts:
        return parts if token.lower() in ("hidden", "is-hidden", "visually-hidden") else set()
    beside = _BESIDE if "header" in parts else _BESIDE | _OF_ARTICLE
    return parts & _CLASSES if parts <= _CLASSES | beside else set()


@lru_cache(maxsize=8192)
def _shape(tag: str, attributes: str) -> tuple[str, bool, int, bool, float]:
    """(name, always left out, left out by name, left out outside an article, bonus) of a start tag.

    The name is the tag with its classes, numbers made alike.
    """
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    tokens = f"{found.get('class', '')} {found.get('id', '')}".split()
    words = {w.lower() for t in tokens for w in _SPLIT.split(t) if w}
    beside = set().union(*map(_left_out, tokens))
    if tag == "article":
        # Names of an article's own kind, as teaser, are no words of other elements.
        beside = (beside | {t.lower() for t in tokens}) & _NO_ARTICLE
    elif tag in ("html", "body", "main"):
        beside = set()
    role = found.get("role", "").lower()
    dropped = (
        tag in _DROPPED
        or tag in _RAW
        or "hidden" in found
        or re.search(r"display\s*:\s*none", found.get("style", ""), re.I) is not None
    )
    # A form or a part of another role may be wrapped around the whole page.
    wraps = tag == "form" or role in _ROLES or found.get("aria-hidden", "").lower() == "true"
    named = 2 if beside & _BESIDES_ARTICLE else 1 if beside or wraps else 0
    bonus = 1.5 if tag in ("article", "main") or role in ("main", "article") else 1.3 if words & _GOOD else 1.0
    if tag in ("body", "html"):
        bonus = 0.6
    name = tag + "".join(f".{re.sub('[0-9]+', '0', c)}" for c in sorted(found.get("class", "").split()))
    return name, dropped, named, tag == "header", bonus


def _node(tag: str, attributes: str, parent: _Node, in_article: bool) -> _Node:
    """The element with its generalised path, and whether its text is left out."""
    name, dropped, named, outside, bonus = _shape(tag, attributes)
    return _Node(tag, name, parent, parent.hidden or dropped or (outside and not in_article), named, bonus)


def _settle(elements: list[_Node], root: _Node) -> None:
    """Decide which elements with a name of something beside the text are left out, with all inside them.

    One stays that holds the page's largest article or main, or most of the page's text. Comments,
    advertisements and the like stay only where no article has text outside them as well.
    """
    holders = set()
    for tag in ("article", "main"):
        node = max((n for n in elements if n.tag == tag and not n.named and n.full), key=lambda n: n.full, default=None)
        while node is not None and node not in holders:
            holders.add(node)
            node = node.parent
    for node in elements:
        if node.named:
            stays = node in holders or 2 * node.full > root.full
            node.dropped |= not stays or (node.named == 2 and root.told > node.told)
        node.dropped |= node.parent.dropped


def blocks(page: str) -> tuple[list[tuple[str, _Node]], list[_Node]]:
    """The page's kept blocks with the innermost element of each, and all elements, outer ones first."""
    root = _Node("", "", None, False, 0, 0.0)
    stack, elements, out, text = [root], [], [], []

    def flush():
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                stack[-1].full += len(joined)
                stack[-1].told += len(joined) if articles else 0
                out.append((joined, stack[-1]))

    inline_dropped: list[str] = []  # open inline elements whose text is left out, and those inside them
    articles = 0
    for kind, value, attributes in _tags(page):
        if kind == "text":
            if not stack[-1].hidden and not inline_dropped:
                text.append(html.unescape(value))
            continue
        if value in _INLINE:
            if value == "br" or value == "img":
                text.append(" ")
            elif kind == "start" and (inline_dropped or (attributes and _MAY_HIDE.search(attributes) and any(_shape(value, attributes)[1:3]))):
                inline_dropped.append(value)
            elif kind == "end" and value in inline_dropped:
                while inline_dropped.pop() != value:
                    pass
            continue
        flush()
        inline_dropped.clear()
        if value in _VOID:
            continue
        if kind == "start":
            if stack[-1].tag == "p":
                stack.pop()
            ends = _CLOSES.get(value)
            if ends:
                scope = _SCOPES[value]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in scope:
                        break
                    if stack[i].tag in ends:
                        articles -= sum(n.tag in ("article", "main") for n in stack[i:])
                        del stack[i:]
                        break
            node = _node(value, attributes, stack[-1], articles > 0)
            articles += value in ("article", "main")
            stack.append(node)
            elements.append(node)
        else:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == value:
                    articles -= sum(n.tag in ("article", "main") for n in stack[i:])
                    del stack[i:]
                    break
    flush()
    for node in reversed(elements):
        node.parent.full += node.full
        node.parent.told += node.told
    _settle(elements, root)
    out = [(block, node) for block, node in out if not node.dropped]
    for block, node in out:
        node.size += len(block)
        if node.tag in _PROSE:
            node.container().prose += len(block)
    for node in reversed(elements):
        node.parent.size += node.size
    return out, elements


def best_container(elements: list[_Node]) -> tuple[_Node | None, float]:
    """The container of highest score, the first of equal ones, and the score.

    An element around it is taken instead when all that this adds are headings and paragraphs of its own.
    """
    best, score = None, 0.0
    for node in elements:
        if not node.dropped and (node.tag in _CONTAINERS or node.tag == "body") and node.size * node.bonus > score:
            best, score = node, node.size * node.bonus
    node = best
    while node is not None and node.parent is not None:
        node = node.parent
        if node.dropped or node.size - best.size > node.prose:
            break
        if node.size > best.size and (node.tag in _CONTAINERS or node.tag == "body"):
            best = node
    return best, score


def best_path(elements: list[_Node]) -> tuple[str, float]:
    """Path and score of the best container."""
    best, score = best_container(elements)
    return (best.path, score) if best else ("", 0.0)


def extract(page: str, path: str | None = None) -> str:
    """The blocks inside the containers of ``path``, else of the page's own best container."""
    found, elements = blocks(page)

    def marked(wanted: str) -> bool:
        key, some = zlib.crc32(wanted.encode()), False
        for node in elements:
            # Most keys differ; only equal ones are spelled out.
            here = node.key == key and not node.dropped and (node.tag in _CONTAINERS or node.tag == "body") and node.path == wanted
            node.inside = node.parent.inside or here
            some |= here and node.size > 0
        return some

    if path is None or not marked(path):
        path = best_path(elements)[0]
        if not path:
            return "\n\n".join(block for block, _ in found)
        marked(path)
    return "\n\n".join(block for block, node in found if node.inside)


def main_text(pages: DataFrame, url: str, page: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``pages`` with ``text`` and ``path``, the winning path of the url's host.

    A null page is empty and gives an empty text. Pages with a null or unreadable url share the
    empty host. Repeated rows are extracted alike. A host's ties go to the higher score, then the
    greater path. Kept columns named ``text`` or ``path`` are replaced. An empty table gives no rows. A page
    of any length is one row and is read once for the vote and once for the text.
    """
    shipped(pages.sparkSession)
    keep = [c for c in keep if c not in ("text", "path")]
    names = [f"k{i}" for i in range(len(keep))]
    rows = pages.select(
        *[pages[c].alias(n) for c, n in zip(keep, names)], host(pages[url]).alias("host"), whole(pages[page]).alias("html")
    )

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cast: dict[tuple[str, str], list] = {}
            for h, text in zip(batch.column("host"), batch.column("html")):
                path, score = best_path(blocks(text.as_py())[1])
                if path:
                    total = cast.setdefault((h.as_py(), path), [0, 0.0])
                    total[0] += 1
                    total[1] += score
            if cast:
                yield pa.RecordBatch.from_pydict({
                    "host": [h for h, _ in cast], "path": [p for _, p in cast],
                    "votes": pa.array([v for v, _ in cast.values()], pa.int64()), "score": [s for _, s in cast.values()],
                })

    votes = rows.select("host", "html").mapInArrow(vote, "host string, path string, votes long, score double")
    counted = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))
    winners = counted.groupBy("host").agg(F.max(F.struct("votes", "score", "path")).alias("best"))
    winners = written(winners.select("host", F.col("best.path").alias("path")), "host_paths")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(t.as_py(), p.as_py()) for t, p in zip(batch.column("html"), batch.column("path"))]
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(texts, pa.string()), batch.column("path")], [*names, "text", "path"]
            )

    kinds = "".join(f"{n} {rows.schema[n].dataType.simpleString()}, " for n in names)
    found = rows.join(winners, "host", "left").select(*names, "html", "path").mapInArrow(take, f"{kinds}text string, path string")
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "text", "path")
