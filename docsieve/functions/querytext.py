"""Query texts: words, phrases, fields, ranges, AND, OR and NOT, read into a small tree.

``one two`` and ``one OR two`` ask for either, ``one AND two`` for both, and AND binds tighter. ``+x``
must hold. ``-x``, ``!x`` and ``NOT x`` must not; a list of such clauses alone means all other rows.
``"one two"`` is a phrase, ``"one two"~3`` lets its words move by three places in all, ``pre*`` and
``w?rd`` are patterns, ``word~1`` allows one edit (``~`` alone two), ``[a TO b]`` and ``{a TO b}`` are ranges
with and without their ends, ``field:`` in front of a word, phrase, range or group names the field,
``*:*`` is every row, ``field:*`` every row with a value, and ``^2`` doubles a clause's share of the score.
A backslash makes the next character plain.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

_TOKEN = re.compile(
    r"""
    (?P<space>\s+)
  | (?P<quote>"(?:[^"\\]|\\.)*")
  | (?P<range>[\[{]\s*(?:"[^"]*"|[^\s\]}]+)\s+TO\s+(?:"[^"]*"|[^\s\]}]+)\s*[\]}])
  | (?P<open>\() | (?P<close>\))
  | (?P<boost>\^\d+(?:\.\d+)?)
  | (?P<tilde>~\d*)
  | (?P<op>(?:AND|OR|NOT)(?=[\s("+-]|$) | && | \|\| | ! | (?:(?<=[\s(:])|^)[+-](?=\S))
  | (?P<field>(?:\*|[A-Za-z_][\w.]*):(?=\S))
  | (?P<word>(?:[^\s()"\[\]{}^~\\]|\\.)+)
    """,
    re.X,
)
_RANGE = re.compile(r'([\[{])\s*(?:"([^"]*)"|(\S+))\s+TO\s+(?:"([^"]*)"|([^\s\]}]+))\s*([\]}])')


@dataclass(frozen=True)
class Leaf:
    """One clause. ``kind`` is words, phrase, pattern, fuzzy, range, exists or all; ``field`` None is the default."""

    kind: str
    value: str = ""
    field: str | None = None
    near: int = 0
    bounds: tuple = ()
    boost: float = 1.0


@dataclass(frozen=True)
class Group:
    """All of ``must``, else any of ``should``, and none of ``must_not``."""

    must: tuple = ()
    should: tuple = ()
    must_not: tuple = ()


Node = Leaf | Group


def _plain(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text)


class _Parser:
    """Recursive descent over the tokens: list of AND chains of signed clauses."""

    def __init__(self, text: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise ValueError(f"unreadable query at {text[at:at + 20]!r}")
            if m.lastgroup != "space":
                self.tokens.append((m.lastgroup, m.group()))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self) -> tuple[str, str]:
        token = self.peek()
        self.at += 1
        return token

    def any_of(self, field: str | None) -> Node:
        items: list[tuple[str, Node]] = []
        joined = False
        while self.peek()[0] not in ("end", "close"):
            if self.peek()[1] in ("OR", "||"):
                if not items:
                    raise ValueError("OR without a clause before it")
                self.take()
                joined = False
            sign, node, chained = self.all_of(field)
            if joined and not chained and sign == "should" and self._bare(node) and items[-1][0] == "should" and self._follows(items[-1][1], node):
                # Plain words side by side are one text, so that synonyms of several words are seen.
                items[-1] = ("should", replace(items[-1][1], value=f"{items[-1][1].value} {node.value}"))
            else:
                items.append((sign, node))
            joined = not chained
        if not items:
            raise ValueError("an empty query or group")
        return self.grouped(items)

    @staticmethod
    def _bare(node: Node) -> bool:
        return isinstance(node, Leaf) and node.kind == "words"

    def _follows(self, before: Node, node: Leaf) -> bool:
        return self._bare(before) and (before.field, before.boost) == (node.field, node.boost)

    @staticmethod
    def grouped(items: Sequence[tuple[str, Node]]) -> Node:
        if len(items) == 1 and items[0][0] == "should":
            return items[0][1]
        return Group(*[tuple(n for s, n in items if s == sign) for sign in ("must", "should", "must_not")])

    def all_of(self, field: str | None) -> tuple[str, Node, bool]:
        items = [self.signed(field)]
        while self.peek()[1] in ("AND", "&&"):
            self.take()
            items.append(self.signed(field))
        if len(items) == 1:
            return (*items[0], False)
        return "should", self.grouped([("must" if s == "should" else s, n) for s, n in items]), True

    def signed(self, field: str | None) -> tuple[str, Node]:
        sign = "should"
        while self.peek()[0] == "op" and self.peek()[1] in ("NOT", "!", "-", "+"):
            if self.take()[1] == "+":
                sign = "must" if sign == "should" else sign
            else:
                sign = "should" if sign == "must_not" else "must_not"
        return sign, self.clause(field)

    def clause(self, field: str | None) -> Node:
        kind, text = self.take()
        if kind == "field":
            field = text[:-1]
            kind, text = self.take()
        if kind == "open":
            node = self.any_of(field)
            if self.take()[0] != "close":
                raise ValueError("a group is not closed")
            return self.boosted(node)
        if kind == "quote":
            near = 0
            if self.peek()[0] == "tilde":
                near = int(self.take()[1][1:] or 0)
            return self.boosted(Leaf("phrase", _plain(text[1:-1]), field, near))
        if kind == "range":
            left, a, b, c, d, right = _RANGE.match(text).groups()
            low, high = (a if a is not None else b), (c if c is not None else d)
            return self.boosted(Leaf("range", field=field, bounds=(low, high, left == "[", right == "]")))
        if kind != "word":
            raise ValueError(f"a clause is missing before {text!r}" if text else "the query ends where a clause is missing")
        if field == "*" and text == "*":
            return self.boosted(Leaf("all"))
        if text == "*":
            return self.boosted(Leaf("exists", field=field))
        if self.peek()[0] == "tilde":
            return self.boosted(Leaf("fuzzy", _plain(text), field, min(int(self.take()[1][1:] or 2), 2)))
        if re.search(r"(?<!\\)[*?]", text):
            return self.boosted(Leaf("pattern", text, field))
        return self.boosted(Leaf("words", _plain(text), field))

    def boosted(self, node: Node) -> Node:
        if self.peek()[0] != "boost":
            return node
        return scaled(node, float(self.take()[1][1:]))


def scaled(node: Node, by: float) -> Node:
    """The same clauses with their shares of the score multiplied."""
    if isinstance(node, Leaf):
        return replace(node, boost=node.boost * by)
    return Group(*[tuple(scaled(n, by) for n in part) for part in (node.must, node.should, node.must_not)])


def parsed(text: str) -> Node:
    """The tree of a query text; an unreadable one is a ValueError."""
    parser = _Parser(text)
    node = parser.any_of(None)
    if parser.peek()[0] != "end":
        raise ValueError("a group is closed that was not opened")
    return node


def leaves(node: Node) -> list[Leaf]:
    """All clauses in order."""
    if isinstance(node, Leaf):
        return [node]
    return [leaf for part in (node.must, node.should, node.must_not) for n in part for leaf in leaves(n)]


def positive(node: Node) -> list[Leaf]:
    """The clauses that a row may match, which are those that count for its score."""
    if isinstance(node, Leaf):
        return [node]
    return [leaf for part in (node.must, node.should) for n in part for leaf in positive(n)]


__all__ = ["Group", "Leaf", "Node", "leaves", "parsed", "positive", "scaled"]
