"""Search by query text over one or several fields: one Column for the match, BM25F for the score.

Words are looked up with their synonyms, also of several words: the longest synonym phrase at each word
wins, and all its members count as one term. Fields are analysed once each, however many clauses ask for
them, and keep their own lengths: a phrase never reaches from one field into another.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.functions import querytext
from docsieve.functions.predicates import in_range, keep
from docsieve.functions.querytext import Group, Leaf, Node
from docsieve.functions.text import index_terms, let, query_side_terms, synonym_graph, tokenize
from docsieve.operators.keyword import B, K1
from docsieve.operators.select import DEFAULT_ROWS, top_k

# A concept is what counts as one term: alternatives, each a sequence of index terms.
Concept = tuple[tuple[str, ...], ...]


@dataclass(frozen=True)
class Query:
    """A query text with its words analysed: ``concepts`` by leaf, fields with their boosts."""

    tree: Node
    concepts: dict[Leaf, tuple[Concept, ...]]
    fields: dict[str, float]
    text_fields: frozenset[str]

    def fields_of(self, leaf: Leaf) -> list[str]:
        return [leaf.field] if leaf.field not in (None, "*") else list(self.fields)


def prepared(
    df: DataFrame,
    text: str,
    fields: Sequence[str] | dict[str, float],
    text_fields: Sequence[str] = (),
    synonyms: Sequence[Sequence[str]] = (),
) -> Query:
    """Read ``text`` for the columns of ``df``.

    ``fields`` are searched where a clause names none (a dict gives their boosts). They and
    ``text_fields`` are matched by index term, other columns by value. All words of the query are
    analysed in one small job.
    """
    tree = querytext.parsed(text)
    boosts = dict(fields) if isinstance(fields, dict) else {f: 1.0 for f in fields}
    analysed = frozenset([*boosts, *text_fields])
    every = querytext.leaves(tree)
    for leaf in every:
        if leaf.field not in (None, "*") and leaf.field not in df.columns:
            raise ValueError(f"unknown field {leaf.field!r}")
    asked = [x for x in every if x.kind in ("words", "phrase") and (x.field in (None, "*") or x.field in analysed)]
    return Query(tree, dict(zip(asked, _concepts(df.sparkSession, asked, synonyms))), boosts, analysed)


def _concepts(spark: SparkSession, asked: Sequence[Leaf], synonyms: Sequence[Sequence[str]]) -> list[tuple[Concept, ...]]:
    if not asked:
        return []

    def concepts(leaf: Leaf) -> Column:
        if leaf.kind == "phrase":
            return F.array(F.array(query_side_terms(F.lit(leaf.value))))
        graph = synonym_graph(F.transform(tokenize(F.lit(leaf.value)), F.lower), synonyms)
        # Alternatives are analysed like any other text; a word keeps its case for the inner borders.
        if not synonyms:
            graph = F.transform(tokenize(F.lit(leaf.value)), lambda w: F.array(w))
        return F.transform(graph, lambda alternatives: F.transform(alternatives, lambda a: query_side_terms(a)))

    row = spark.range(0, 1, 1, 1).select(F.array(*[concepts(x) for x in asked]).alias("c")).first()
    out = []
    for found in row["c"]:
        ready = []
        for alternatives in found:
            kept = tuple(dict.fromkeys(tuple(a) for a in alternatives if a))
            if kept:
                ready.append(kept)
        out.append(tuple(ready))
    return out


def _bound(named: Sequence[tuple[tuple, Column]], body: Callable[[dict], Column], have: dict | None = None) -> Column:
    """``body`` with every Column of ``named`` computed once."""
    have = have or {}
    if not named:
        return body(have)
    (name, value), rest = named[0], named[1:]
    return let(value, lambda bound: _bound(rest, body, {**have, name: bound}))


def _line(field: str) -> Column:
    return F.concat(F.lit(" "), F.array_join(query_side_terms(F.coalesce(F.col(field), F.lit(""))), " "), F.lit(" "))


def _needs(query: Query, concepts_only: bool = False) -> list[tuple[tuple, Column]]:
    """The analysed forms that clauses look at: the bag of terms, and the terms in order."""
    wanted: dict[tuple, Column] = {}
    for leaf in querytext.positive(query.tree) if concepts_only else querytext.leaves(query.tree):
        for field in query.fields_of(leaf):
            if field not in query.text_fields or leaf.kind in ("range", "exists", "all"):
                continue
            concepts = query.concepts.get(leaf, ())
            if concepts_only or leaf.kind in ("pattern", "fuzzy") or any(len(a) == 1 for c in concepts for a in c):
                wanted[("bag", field)] = index_terms(F.coalesce(F.col(field), F.lit("")))
            if leaf.kind == "phrase" or any(len(a) > 1 for c in concepts for a in c):
                wanted[("line", field)] = _line(field)
    return list(wanted.items())


def _holds(concept: Concept, field: str, have: dict) -> Column:
    singles = [a[0] for a in concept if len(a) == 1]
    tests = [F.arrays_overlap(have["bag", field], F.array(*[F.lit(s) for s in singles]))] if singles else []
    tests += [have["line", field].contains(f" {' '.join(a)} ") for a in concept if len(a) > 1]
    return reduce(lambda a, b: a | b, tests)


def _moved(terms: Sequence[str], near: int, line: Column) -> Column:
    """True when some choice of places has max - min of (place - rank) <= ``near``."""

    def around(tokens: Column) -> Column:
        def window(low: Column, rank: int, term: str) -> Column:
            first = low + rank + 1
            width = F.lit(near + 1) - F.greatest(F.lit(0), 1 - first)
            part = F.slice(tokens, F.greatest(first, F.lit(1)), F.greatest(width, F.lit(0)))
            return (width > 0) & F.array_contains(part, term)

        anchors = F.filter(F.transform(tokens, lambda t, i: F.when(t == terms[0], i)), lambda i: i.isNotNull())
        every = lambda low: reduce(lambda a, b: a & b, [window(low, i, t) for i, t in enumerate(terms)])
        return F.exists(anchors, lambda a: F.exists(F.sequence(a - near, a), every))

    return let(F.split(F.trim(line), " "), around)


def _pattern(text: str) -> str:
    """The regular expression of a word with ``*`` and ``?``, lower-case."""
    out, escaped = [], False
    for ch in text.lower():
        if escaped or ch not in "*?\\":
            out.append(re.escape(ch))
            escaped = False
        elif ch == "\\":
            escaped = True
        else:
            out.append(".*" if ch == "*" else ".")
    return "^" + "".join(out) + "$"


def _matches(query: Query, leaf: Leaf, field: str, df: DataFrame, have: dict) -> Column:
    column = F.col(field)
    if leaf.kind == "exists":
        return column.isNotNull()
    if leaf.kind == "range":
        low, high, with_low, with_high = leaf.bounds
        test = in_range(column, low, high)
        if not with_low and low != "*":
            test &= column != F.lit(low)
        if not with_high and high != "*":
            test &= column != F.lit(high)
        return test
    if field in query.text_fields:
        if leaf.kind == "phrase":
            concepts = query.concepts[leaf]
            if not concepts:
                return F.lit(False)
            terms = concepts[0][0]
            if leaf.near and len(terms) > 1:
                return _moved(terms, leaf.near, have["line", field])
            return have["line", field].contains(f" {' '.join(terms)} ")
        if leaf.kind == "words":
            return reduce(lambda a, b: a | b, [_holds(c, field, have) for c in query.concepts[leaf]])
        bag = have["bag", field]
        if leaf.kind == "fuzzy":
            return F.exists(bag, lambda w: F.levenshtein(w, F.lit(leaf.value.lower()), leaf.near) >= 0)
        plain = re.fullmatch(r"([^*?\\]+)\*", leaf.value)
        if plain:
            return F.exists(bag, lambda w: w.startswith(plain.group(1).lower()))
        return F.exists(bag, lambda w: w.rlike(_pattern(leaf.value)))
    value = column.cast("string") if leaf.kind in ("pattern", "fuzzy") else column
    kind = df.schema[field].dataType
    among = lambda test: F.exists(column, test) if isinstance(kind, T.ArrayType) else test(value)
    if leaf.kind == "pattern":
        return among(lambda v: F.lower(v).rlike(_pattern(leaf.value)))
    if leaf.kind == "fuzzy":
        return among(lambda v: F.levenshtein(F.lower(v), F.lit(leaf.value.lower()), leaf.near) >= 0)
    asked = leaf.value.split() if leaf.kind == "words" else [leaf.value]
    return among(lambda v: v.isin(asked))


def _is_void(query: Query, node: Node) -> bool:
    """A clause of stop words only, which neither matches nor excludes."""
    if isinstance(node, Leaf):
        return node in query.concepts and not query.concepts[node]
    return all(_is_void(query, n) for part in (node.must, node.should, node.must_not) for n in part)


def _tree(query: Query, node: Node, df: DataFrame, have: dict) -> Column:
    if isinstance(node, Leaf):
        if node.kind == "all":
            return F.lit(True)
        tests = [_matches(query, node, field, df, have) for field in query.fields_of(node)]
        return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))
    parts = [[_tree(query, n, df, have) for n in part if not _is_void(query, n)] for part in (node.must, node.should, node.must_not)]
    must, should, must_not = parts
    tests = list(must)
    if should and not must:
        tests.append(reduce(lambda a, b: a | b, should))
    tests += [~t for t in must_not]
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(False)


def condition(df: DataFrame, query: Query) -> Column:
    """The match as one Column. Null values match nothing, so ``NOT`` keeps their rows."""
    if _is_void(query, query.tree):
        return F.lit(False)
    return _bound(_needs(query), lambda have: _tree(query, query.tree, df, have))


def matching(df: DataFrame, query: Query) -> DataFrame:
    """The rows of ``df`` that the query text finds."""
    return keep(df, condition(df, query))


def scored_terms(query: Query) -> list[tuple[Concept, tuple[tuple[str, float], ...]]]:
    """What counts for the score: concepts with the fields they are counted in and their boosts."""
    out = []
    for leaf in querytext.positive(query.tree):
        places = tuple((f, query.fields.get(f, 1.0) * leaf.boost) for f in query.fields_of(leaf) if f in query.text_fields)
        out += [(concept, places) for concept in query.concepts.get(leaf, ())]
    return out


def _frequency(concept: Concept, field: str, have: dict) -> Column:
    singles = [a[0] for a in concept if len(a) == 1]
    several = [" ".join(a) for a in concept if len(a) > 1]
    counts = [F.size(F.filter(have["bag", field], lambda w: w.isin(singles)))] if singles else []
    if several:
        longest_first = "|".join(re.escape(s) for s in sorted(several, key=len, reverse=True))
        counts.append(F.regexp_count(have["line", field], F.lit(f"(?<= )(?:{longest_first})(?= )")))
    return reduce(lambda a, b: a + b, counts)


def frequencies(query: Query) -> Column:
    """Struct of ``dl`` (terms per field) and ``tf`` (per counted concept, one number per field of it)."""
    terms = scored_terms(query)
    fields = list(dict.fromkeys(f for _, places in terms for f, _ in places))
    needs = dict(_needs(query, concepts_only=True))
    for field in fields:
        needs.setdefault(("bag", field), index_terms(F.coalesce(F.col(field), F.lit(""))))

    def body(have: dict) -> Column:
        lengths = F.array(*[F.size(have["bag", f]) for f in fields])
        counts = F.array(*[F.array(*[_frequency(c, f, have) for f, _ in places]) for c, places in terms])
        return F.struct(lengths.alias("dl"), counts.alias("tf"))

    return _bound(list(needs.items()), body)


def scored(df: DataFrame, query: Query, where: Column | None = None) -> DataFrame:
    """All matching rows with a ``score`` (BM25F, Robertson, Zaragoza and Taylor 2004).

    A concept's count in a field is divided by the field's length norm, multiplied by its boost and added
    up over the fields before it saturates; with one field this is BM25. A concept occurs in a row when it
    occurs in one of its fields. Patterns, ranges and exclusions do not score. ``where`` narrows the result,
    not the corpus figures; empty and null fields count with length 0.
    """
    terms = scored_terms(query)
    if not terms:
        found = matching(df if where is None else df.where(where), query)
        return found.withColumn("score", F.lit(0.0))
    fields = list(dict.fromkeys(f for _, places in terms for f, _ in places))
    n_fields, n_terms = len(fields), len(terms)
    total = lambda counts: F.aggregate(counts, F.lit(0), lambda a, b: a + b)
    corpus = df.select(frequencies(query).alias("f")).agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.avg(F.get("f.dl", F.lit(i))) for i in range(n_fields)]).alias("avgdl"),
            F.array(*[F.count_if(total(F.get("f.tf", F.lit(i))) > 0) for i in range(n_terms)]).alias("df"),
        ).alias("c")
    ).scalar()
    hits = matching(df if where is None else df.where(where), query)
    # The counts leave through a generator of one row, so that they are made once and for the matches only.
    rows = hits.select("*", F.inline(F.array(frequencies(query)))).withColumn("_c", corpus)
    weights = []
    for i, (_, places) in enumerate(terms):
        share = []
        for j, (field, boost) in enumerate(places):
            at = F.lit(fields.index(field))
            norm = 1 - B + B * F.get("dl", at) / F.get("_c.avgdl", at)
            tf = F.get(F.get("tf", F.lit(i)), F.lit(j))
            share.append(F.when(tf > 0, boost * tf / norm).otherwise(0.0))
        t = reduce(lambda a, b: a + b, share)
        rare = F.get("_c.df", F.lit(i))
        weights.append(F.log(1 + (F.col("_c.n") - rare + 0.5) / (rare + 0.5)) * t / (t + K1))
    return rows.withColumn("score", reduce(lambda a, b: a + b, weights)).drop("dl", "tf", "_c")


def search(
    df: DataFrame,
    text: str,
    fields: Sequence[str] | dict[str, float],
    key: str,
    rows: int = DEFAULT_ROWS,
    text_fields: Sequence[str] = (),
    synonyms: Sequence[Sequence[str]] = (),
    where: Column | None = None,
) -> DataFrame:
    """The ``rows`` best matches of a query text; equal scores are ordered by key."""
    return top_k(scored(df, prepared(df, text, fields, text_fields, synonyms), where), "score", key, rows)


def highlight_text(query: Query) -> str:
    """The words that a highlighter should mark: those of the positive clauses and of their synonyms."""
    found = [term for concept, _ in scored_terms(query) for alternative in concept for term in alternative]
    return " ".join(dict.fromkeys(found))
