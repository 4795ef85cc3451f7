"""Main text of odd pages, and all test pages against a plain version on the standard library's parser."""

import html.parser
import time

import pyarrow.parquet as pq
import pytest

from docsieve.llm import htmltext as H

LONG = " ".join(f"word{i}" for i in range(80))


@pytest.mark.parametrize("page, text", [
    (f'<body><form id="aspnetForm"><div class="menu"><a>Home</a></div><div id="c"><h1>Title</h1><p>{LONG}</p></div></form></body>', f"Title\n\n{LONG}"),
    (f'<body><div role="banner">Top</div><div role="dialog"><article><p>{LONG}</p></article></div></body>', LONG),
    (f'<body><div aria-hidden="true"><p>{LONG}</p></div><div class="b">x</div></body>', LONG),
    (f'<body><form role="search"><label>Find</label><input></form><div><p>{LONG}</p></div><div role="navigation" class="b">a b</div></body>', LONG),
    (f'<div id="wrap"><h1>Title</h1><p class="lead">Lead.</p><div class="text"><p>{LONG}</p></div></div>', f"Title\n\nLead.\n\n{LONG}"),
    (f"<body><h1>Head</h1><p>Intro.</p><div><p>{LONG}</p></div><p>Closing.</p></body>", f"Head\n\nIntro.\n\n{LONG}\n\nClosing."),
    (f"<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math>, {LONG}</p></article>", f"Let x=2, {LONG}"),
    (f"<div><p>a <![CDATA[ x > y ]]> b {LONG}</p></div>", f"a b {LONG}"),
    (f"<div><p>a <!--> b <!---> c <!-- > d --> {LONG}</p></div>", f"a b c {LONG}"),
    (f'<div><div class="w-1/2"><p>{LONG}</p></div></div>', LONG),
])
def test_no_article_is_lost(page, text):
    assert H.extract(page) == text


def test_deep_pages_take_little():
    start = time.time()
    page = "<div>" * 20_000 + "".join(f"<p>b{i}" for i in range(20_000))
    assert H.extract(page).count("\n\n") == 19_999
    assert time.time() - start < 20


def test_names_of_kept_columns_do_not_clash(spark):
    rows = [("http://a.org/1", f"<p>{LONG}</p>", "k", "h", "t", 1), (None, None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "url string, html string, host string, k0 string, text string, path int")
    found = H.main_text(pages, "url", "html", ["url", "html", "host", "k0", "text", "path"])
    assert found.columns == ["url", "html", "host", "k0", "text", "path"]
    assert sorted(((r["url"], r["host"], r["k0"], r["text"]) for r in found.collect()), key=repr) == [
        ("http://a.org/1", "k", "h", LONG), (None, None, None, ""),
    ]
    assert H.main_text(pages.limit(0), "url", "html", ["url"]).count() == 0


class Plain(html.parser.HTMLParser):
    """The page as nested lists [tag, attributes, children], by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = ["", "", []]
        self.stack = [self.root]
        self.raw = 0

    def handle_starttag(self, tag, attrs):
        if self.raw:
            return
        if tag in H._RAW:
            self.raw_tag, self.raw = tag, 1
            if tag not in H._INLINE:
                self.stack[-1][2].append(["#break", "", []])
            return
        if tag in H._VOID:
            self.stack[-1][2].append(" " if tag in ("br", "img") else "" if tag in H._INLINE else ["#break", "", []])
            return
        if tag not in H._INLINE:
            while self.stack[-1][0] in H._INLINE:
                self.stack.pop()
            if self.stack[-1][0] == "p":
                self.stack.pop()
            for i in range(len(self.stack) - 1, 0, -1):
                if tag not in H._CLOSES or self.stack[i][0] in H._SCOPES[tag]:
                    break
                if self.stack[i][0] in H._CLOSES[tag]:
                    del self.stack[i:]
                    break
        node = [tag, self.get_starttag_text()[1 + len(tag) : -1], []]
        self.stack[-1][2].append(node)
        self.stack.append(node)

    def handle_endtag(self, tag):
        if self.raw:
            self.raw = self.raw and tag != self.raw_tag
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break
            if tag in H._INLINE and self.stack[i][0] not in H._INLINE:
                break

    def handle_data(self, data):
        if not self.raw:
            self.stack[-1][2].append(data)


def plain_text(page):
    """Every step over the tree, sums taken anew wherever they are needed."""
    parser = Plain()
    parser.feed(page)
    parser.close()
    nodes, texts = [], []  # [tag, parent, hidden, named, bonus]; (innermost node, text, in an article)

    def walk(tree, at, hidden, dropped, articles):
        run = []

        def flush():
            joined = " ".join("".join(run).split())
            run.clear()
            if joined:
                texts.append((at, joined, articles > 0))

        def inline(child, gone):
            for x in child[2]:
                if isinstance(x, str):
                    if not hidden and not gone:
                        run.append(x)
                elif x[0] in H._INLINE:
                    inline(x, gone or any(H._shape(x[0], x[1])[1:3]) and bool(x[1]))
                else:
                    block(x)

        def block(x):
            flush()
            if x[0] == "#break":
                return
            _, out, named, outside, bonus = H._shape(x[0], x[1])
            hides = hidden or out or (outside and not articles)
            nodes.append([x[0], at, hides, named, bonus])
            walk(x, len(nodes) - 1, hides, dropped, articles + (x[0] in ("article", "main")))

        inline(tree, False)
        flush()

    walk(parser.root, -1, False, False, 0)
    above = lambda i: [] if i < 0 else [i, *above(nodes[i][1])]
    total = lambda i, told=False: sum(len(t) for n, t, a in texts if (i in above(n) or i < 0) and (a or not told))
    holders = set()
    for tag in ("article", "main"):
        held = [i for i, n in enumerate(nodes) if n[0] == tag and not n[3] and total(i)]
        if held:
            holders |= set(above(max(held, key=lambda i: (total(i), -i))))
    dropped = []
    for i, (tag, up, hides, named, _) in enumerate(nodes):
        gone = hides or (up >= 0 and dropped[up])
        if named:
            stays = i in holders or 2 * total(i) > total(-1)
            gone = gone or not stays or (named == 2 and total(-1, True) > total(i, True))
        dropped.append(gone)
    kept = [(n, t) for n, t, _ in texts if n < 0 or not dropped[n]]
    size = lambda i: sum(len(t) for n, t in kept if i in above(n))
    holds = lambda i: nodes[i][0] in H._CONTAINERS or nodes[i][0] == "body"
    own = lambda n: next((i for i in above(n) if holds(i)), -1)
    best, score = None, 0.0
    for i, n in enumerate(nodes):
        if holds(i) and not dropped[i] and size(i) * n[4] > score:
            best, score = i, size(i) * n[4]
    if best is None:
        return "\n\n".join(t for _, t in kept)
    for i in above(best)[1:]:
        prose = sum(len(t) for n, t in kept if n >= 0 and nodes[n][0] in H._PROSE and own(n) == i)
        if dropped[i] or size(i) - size(best) > prose:
            break
        if size(i) > size(best) and holds(i):
            best = i
    # All containers of the same path belong together.
    name = lambda i: H._shape(nodes[i][0], attributes[i])[0]
    attributes = tree_attributes(parser.root)
    path = lambda i: [name(j) for j in above(i)]
    same = {i for i in range(len(nodes)) if holds(i) and not dropped[i] and path(i) == path(best)}
    return "\n\n".join(t for n, t in kept if same & set(above(n)))


def tree_attributes(tree):
    """Attributes of the block elements in the order of the walk."""
    out = []
    for x in tree[2]:
        if isinstance(x, str) or x[0] == "#break":
            continue
        if x[0] not in H._INLINE:
            out.append(x[1])
        out += tree_attributes(x)
    return out


def test_all_test_pages_against_the_plain_version():
    table = pq.read_table("/root/testdata/sf0.01/pages.parquet")
    differ = [u for u, page in zip(table["url"].to_pylist(), table["html"].to_pylist()) if H.extract(page or "") != plain_text(page or "")]
    assert differ == []
