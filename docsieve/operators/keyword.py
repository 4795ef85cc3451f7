"""Keyword ranking, phrases, highlighting and per-field diagnosis."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsieve.functions.text import (
    _col,
    index_terms,
    let,
    may_hold_term,
    query_side_terms,
    query_terms,
    surface_forms,
)
from docsieve.functions.predicates import has_any_term, keep
from docsieve.operators.select import DEFAULT_ROWS, top_k

K1 = 1.2
B = 0.75


def bm25_weight(n: Column, df: Column, tf: Column, dl: Column, avgdl: Column) -> Column:
    """One term's share of the score (Robertson and Zaragoza 2009)."""
    idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
    return idf * tf / (tf + K1 * (1 - B + B * dl / avgdl))


def term_frequencies(text: Column | str, terms: Sequence[str]) -> Column:
    """Struct of ``dl`` (document length) and ``tf`` (one count per query term).

    The text is analysed once, whatever the number of terms.
    """

    def counted(bag: Column) -> Column:
        # Query terms are few, so one pass leaves a short list to count in.
        asked = let(
            F.filter(bag, lambda w: w.isin(list(terms))),
            lambda hits: F.array(*[F.size(hits) - F.size(F.array_remove(hits, t)) for t in terms]),
        )
        return F.struct(F.size(bag).alias("dl"), asked.alias("tf"))

    return let(index_terms(text), counted)


def score(
    df: DataFrame,
    text: Column | str,
    query: str | Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """All matching rows with a BM25 ``score``; several terms count as any-of.

    Corpus figures (rows, mean length, one document count per query term) come from one
    aggregation over the whole table and enter the plan as a scalar subquery. ``where`` narrows
    the result and reaches the scan, but does not change the corpus figures.
    """
    spark = df.sparkSession
    terms = query_terms(spark, query) if isinstance(query, str) else list(query)
    if not terms:
        return df.where(F.lit(False)).withColumn("score", F.lit(0.0))
    # Only the text is needed for the figures; column pruning keeps the rest unread.
    lengths = df.select(term_frequencies(text, terms).alias("f"))
    corpus = lengths.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.avg("f.dl").alias("avgdl"),
            F.array(
                *[F.count_if(F.get("f.tf", F.lit(i)) > 0) for i in range(len(terms))]
            ).alias("df"),
        ).alias("c")
    ).scalar()
    hits = df if where is None else df.where(where)
    # The match test sits inside a generator of at most one row: as a filter it would be
    # pushed below the projection and the text would be analysed a second time.
    found = F.filter(
        F.array(term_frequencies(text, terms)), lambda f: F.exists(f["tf"], lambda x: x > 0)
    )
    scored = (
        hits.where(may_hold_term(text, terms))
        .select("*", F.inline(found))
        .withColumn("_c", corpus)
    )
    weights = [
        bm25_weight(
            F.col("_c.n"), F.get("_c.df", F.lit(i)), F.get("tf", F.lit(i)), F.col("dl"),
            F.col("_c.avgdl"),
        )
        for i in range(len(terms))
    ]
    return scored.withColumn("score", reduce(lambda a, b: a + b, weights)).drop("dl", "tf", "_c")


def search(
    df: DataFrame,
    text: Column | str,
    query: str | Sequence[str],
    key: str,
    rows: int = DEFAULT_ROWS,
    where: Column | None = None,
) -> DataFrame:
    """The ``rows`` best matches; equal scores are ordered by key."""
    return top_k(score(df, text, query, where), "score", key, rows)


def phrase(df: DataFrame, text: Column | str, query: str) -> DataFrame:
    """Rows where the query terms follow each other directly.

    The analysed text becomes one line of terms; a phrase is then a substring of it.
    """
    terms = query_terms_in_order(df, query)
    line = F.concat(F.lit(" "), F.array_join(query_side_terms(text), " "), F.lit(" "))
    wanted = " " + " ".join(terms) + " "
    return keep(df.where(_may_hold_all(text, terms)), line.contains(wanted))


def query_terms_in_order(df: DataFrame, query: str) -> list[str]:
    row = df.sparkSession.range(0, 1, 1, 1).select(query_side_terms(F.lit(query)).alias("t")).first()
    if not row["t"]:
        raise ValueError("the query has no terms")
    return row["t"]


def _may_hold_all(text: Column | str, terms: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [may_hold_term(text, [t]) for t in terms])


def near(df: DataFrame, text: Column | str, query: str, slop: int) -> DataFrame:
    """Rows where every term lies at most ``slop`` moves away from its phrase place.

    With ``o_i`` = position of term i minus i, a row matches when some choice of positions
    has max(o) - min(o) <= slop. Every such choice has its minimum within ``slop`` below an
    occurrence of the first term, so only short windows around those are looked at and the
    work grows with the length of the text, not with its square.
    """
    terms = query_terms_in_order(df, query)

    def window_holds(tokens: Column, low: Column, place: int, term: str) -> Column:
        # 1-based slice of the positions low + place .. low + place + slop.
        first = low + place + 1
        width = F.lit(slop + 1) - F.greatest(F.lit(0), 1 - first)
        return (width > 0) & F.array_contains(
            F.slice(tokens, F.greatest(first, F.lit(1)), F.greatest(width, F.lit(0))), term
        )

    def all_near(tokens: Column, anchor: Column) -> Column:
        return F.exists(
            F.sequence(anchor - slop, anchor),
            lambda low: reduce(
                lambda a, b: a & b,
                [window_holds(tokens, low, i, t) for i, t in enumerate(terms)],
            ),
        )

    def matches(tokens: Column) -> Column:
        anchors = F.filter(
            F.transform(tokens, lambda t, i: F.when(t == terms[0], i)), lambda i: i.isNotNull()
        )
        return F.exists(anchors, lambda anchor: all_near(tokens, anchor))

    return keep(df.where(_may_hold_all(text, terms)), let(query_side_terms(text), matches))


def highlight(
    df: DataFrame,
    key: str,
    fields: Sequence[str],
    query: str,
    snippets: int = 3,
    fragsize: int = 100,
    method: str = "unified",
) -> DataFrame:
    """(key, field, rank, snippet) for fields that match, best snippets first.

    A fragment is ``fragsize`` characters plus the rest of the last word. Words whose index
    term is a query term are wrapped in ``<em>``. ``method`` is accepted for its three names,
    which differ only in speed elsewhere.
    """
    word, lines = _snippets(df, fields, query, snippets, fragsize, method)
    matching = reduce(lambda a, b: a | b, [F.col(f).rlike(word) for f in fields])
    return df.where(matching).select(key, F.inline(lines))


def with_highlights(
    hits: DataFrame,
    fields: Sequence[str],
    query: str,
    snippets: int = 3,
    fragsize: int = 100,
    method: str = "unified",
) -> DataFrame:
    """Search hits with their snippets; hits without any keep one row with nulls.

    The snippets are cut from the hit rows themselves, so the search runs once and no join
    by key is needed.
    """
    _, lines = _snippets(hits, fields, query, snippets, fragsize, method)
    return hits.select("*", F.inline_outer(lines))


def _snippets(
    df: DataFrame, fields: Sequence[str], query: str, snippets: int, fragsize: int, method: str
) -> tuple[str, Column]:
    """Pattern of the words to mark, and the array of (field, rank, snippet) of a row."""
    if method not in ("unified", "original", "fastVector"):
        raise ValueError(f"unknown highlight method {method!r}")
    forms = surface_forms(df.sparkSession, query)
    if not forms:
        raise ValueError("the query has no terms")
    words = "|".join(re.escape(f) for f in forms)
    word = rf"(?iu)(?<![\p{{L}}\p{{N}}])({words})(?![\p{{L}}\p{{N}}])"
    fragment = rf"(?s).{{1,{fragsize}}}\S*\s*"

    def best(field: str) -> Column:
        pieces = F.regexp_extract_all(F.col(field), F.lit(fragment), F.lit(0))
        ranked = F.transform(
            pieces,
            lambda p, i: F.struct(
                (-F.regexp_count(p, F.lit(word))).alias("order"),
                i.alias("position"),
                p.alias("piece"),
            ),
        )
        hits = F.slice(F.array_sort(F.filter(ranked, lambda r: r["order"] < 0)), 1, snippets)
        return F.transform(
            hits,
            lambda r, i: F.struct(
                F.lit(field).alias("field"),
                (i + 1).alias("rank"),
                F.regexp_replace(r["piece"], word, "<em>$1</em>").alias("snippet"),
            ),
        )

    nothing = F.array().cast("array<struct<field:string,rank:int,snippet:string>>")
    return word, F.concat(*[F.coalesce(best(f), nothing) for f in fields])


def diagnose(df: DataFrame, fields: Sequence[str], term: str) -> DataFrame:
    """Number of matching rows per text field, from one pass."""
    terms = query_terms(df.sparkSession, term)
    counts = [F.count_if(has_any_term(f, terms)).alias(f"m_{i}") for i, f in enumerate(fields)]
    lines = F.array(
        *[
            F.struct(F.lit(f).alias("field"), F.col(f"m_{i}").alias("matches"))
            for i, f in enumerate(fields)
        ]
    )
    return df.agg(*counts).select(F.inline(lines))
