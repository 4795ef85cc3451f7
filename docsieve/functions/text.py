"""Text analysis as native Column expressions.

The index chain is: words -> stop words -> word parts -> lower case -> plural stem ->
duplicates at one position dropped. All of it stays inside the JVM and inside the row,
so analysing a table never shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The default stop words and synonym groups of the schema.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()

SYNONYM_GROUPS = [
    ["bitcoin", "btc"],
    ["blockchain", "distributed ledger"],
    ["cryptocurrency", "crypto"],
    [
        "double spend",
        "double spending",
        "double-spend",
        "double-spending",
        "doublespend",
        "doublespending",
    ],
    ["consensus", "agreement"],
    ["transaction", "tx"],
    ["block", "blocks"],
    ["mining", "miner", "miners"],
    ["peer to peer", "peer-to-peer", "p2p"],
    ["cryptographic", "cryptography", "crypto"],
    ["distributed ledger", "blockchain"],
    ["proof of work", "pow"],
    ["hash", "hashing"],
]

WORD = r"[\p{L}\p{N}]+"
WORD_RUN = r"\p{L}+|\p{N}+"
CASE_CHANGE = r"(\p{Ll})(\p{Lu})"
INNER_BOUNDARY = r"\p{Ll}\p{Lu}|\p{L}\p{N}|\p{N}\p{L}"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use in ``body``, where Spark would compute it per use."""
    return F.transform(F.array(value), body)[0]


def tokenize(text: Column | str) -> Column:
    """Maximal runs of letters and digits, in order."""
    return F.regexp_extract_all(_col(text), F.lit(WORD), F.lit(0))


def drop_stop_words(tokens: Column | str, stops: Iterable[str] = STOP_WORDS) -> Column:
    stops = sorted({s.lower() for s in stops})
    if not stops:
        return _col(tokens)
    return F.filter(_col(tokens), lambda t: ~F.lower(t).isin(stops))


def word_parts(token: Column | str, joined: bool = True) -> Column:
    """Split one word at case changes and letter/digit borders.

    With ``joined`` (index side) the unsplit letter and digit runs are added; the query
    side leaves them out.
    """
    token = _col(token)
    spaced = F.regexp_replace(token, CASE_CHANGE, "$1 $2")
    parts = F.regexp_extract_all(spaced, F.lit(WORD_RUN), F.lit(0))
    if not joined:
        return parts
    return F.array_union(parts, F.regexp_extract_all(token, F.lit(WORD_RUN), F.lit(0)))


def stem(word: Column | str) -> Column:
    """Plural stemmer (Harman 1991) for lower-case words of three letters or more.

    ``ies`` becomes ``y``, any other plural ``s`` goes; words on ``us``, ``ss``, ``aies``,
    ``eies``, ``aes``, ``ees`` and ``oes`` are exceptions and stay.
    """
    w = _col(word)
    size = F.length(w)

    def ends(*suffixes: str) -> Column:
        return reduce(lambda a, b: a | b, [w.endswith(s) for s in suffixes])

    return (
        F.when(~w.endswith("s") | (size < 3) | ends("us", "ss"), w)
        .when(
            ends("ies") & (size > 3) & ~ends("aies", "eies"),
            F.concat(F.substring(w, F.lit(1), size - 3), F.lit("y")),
        )
        .when(ends("ies", "aes", "ees", "oes"), w)
        .otherwise(F.substring(w, F.lit(1), size - 1))
    )


def terms_by_position(
    text: Column | str, stops: Iterable[str] = STOP_WORDS, joined: bool = True
) -> Column:
    """One array of terms per kept word. Parts of a word share its position."""

    def lowered(token: Column) -> Column:
        # Few words have inner borders; the others skip the splitting work.
        return F.when(
            token.rlike(INNER_BOUNDARY), F.transform(word_parts(token, joined), F.lower)
        ).otherwise(F.array(F.lower(token)))

    def stemmed(words: Column) -> Column:
        stems = F.transform(words, stem)
        return F.when(F.size(words) == 1, stems).otherwise(F.array_distinct(stems))

    return F.transform(F.transform(drop_stop_words(tokenize(text), stops), lowered), stemmed)


def index_terms(text: Column | str, stops: Iterable[str] = STOP_WORDS) -> Column:
    """Bag of index terms of a text, in order, repeats kept.

    Texts without any inner word border (most of them) take a shorter path with the same
    result: no splitting, no nested arrays, one lower-casing per word.
    """
    text = _col(text)
    stops = sorted({s.lower() for s in stops})
    lowered = F.transform(tokenize(text), F.lower)
    kept = F.filter(lowered, lambda w: ~w.isin(stops)) if stops else lowered
    return F.when(
        text.rlike(INNER_BOUNDARY), F.flatten(terms_by_position(text, stops))
    ).otherwise(F.transform(kept, stem))


def query_side_terms(text: Column | str, stops: Iterable[str] = STOP_WORDS) -> Column:
    """Terms of a query text: as indexed, but without the joined word forms."""
    return F.flatten(terms_by_position(text, stops, joined=False))


def dedupe_at_position(positioned: Column | str) -> Column:
    """Drop repeats of (position, term) pairs; the same term elsewhere stays.

    ``array_distinct`` compares structs pair by pair, the square of a text's words. Sorted with their
    places, repeats are neighbours; the first of each stays, and the order of the array comes back.
    """

    def firsts(placed: Column) -> Column:
        new = F.filter(placed, lambda x, i: (i == 0) | ~x["p"].eqNullSafe(F.get(placed, i - 1)["p"]))
        return F.transform(F.sort_array(F.transform(new, lambda x: F.struct(x["i"], x["p"]))), lambda x: x["p"])

    placed = F.transform(_col(positioned), lambda p, i: F.struct(p.alias("p"), i.alias("i")))
    return let(F.sort_array(placed), firsts)


def copy_to_text(*fields: Column | str) -> Column:
    """Roll several fields (plain or array of strings) into one searchable text."""
    return F.concat_ws(" ", *[_col(f) for f in fields])


def analysis_stages(text: Column | str, stops: Iterable[str] = STOP_WORDS) -> dict[str, Column]:
    """Text after each stage of the index chain, words joined by a blank."""
    words = tokenize(text)
    kept = drop_stop_words(words, stops)
    parts = F.flatten(
        F.transform(
            kept, lambda t: F.when(t.rlike(INNER_BOUNDARY), word_parts(t)).otherwise(F.array(t))
        )
    )
    lowered = F.transform(parts, F.lower)
    stages = {
        "1_words": words,
        "2_stop_words": kept,
        "3_word_parts": parts,
        "4_lower_case": lowered,
        "5_stem": F.transform(lowered, stem),
        "6_distinct": index_terms(text, stops),
    }
    return {name: F.array_join(value, " ") for name, value in stages.items()}


def may_hold_term(text: Column | str, terms: Sequence[str]) -> Column:
    """Cheap test that every text holding one of the terms passes, run before analysis."""
    if not terms or any(not t.isascii() for t in terms):
        return F.lit(True)
    parts = [t[:-1] if t.endswith("y") else t for t in terms]
    # Bound once: a plain filter would lower-case the text again for every term.
    return let(
        F.lower(_col(text)), lambda low: reduce(lambda a, b: a | b, [low.contains(p) for p in parts])
    )


# Terms of query texts seen before; a pure function of the text and the stop words.
_analysed: dict[tuple, list[str]] = {}


def query_terms(spark: SparkSession, text: str, stops: Iterable[str] = STOP_WORDS) -> list[str]:
    """Distinct terms of one query text, by the same expressions as the table side."""
    asked = ("terms", text, tuple(stops))
    if asked not in _analysed:
        terms = F.array_distinct(query_side_terms(F.lit(text), stops))
        _analysed[asked] = spark.range(0, 1, 1, 1).select(terms.alias("t")).first()["t"]
    return list(_analysed[asked])


def surface_forms(spark: SparkSession, text: str, stops: Iterable[str] = STOP_WORDS) -> list[str]:
    """Lower-case words that the index chain maps to a term of the query text."""
    asked = ("forms", text, tuple(stops))
    if asked not in _analysed:

        def forms(t: Column) -> Column:
            plural = F.concat(F.regexp_replace(t, "y$", ""), F.lit("ies"))
            return F.filter(F.array(t, F.concat(t, F.lit("s")), plural), lambda f: stem(f) == t)

        every = F.flatten(F.transform(query_side_terms(F.lit(text), stops), forms))
        row = spark.range(0, 1, 1, 1).select(F.sort_array(F.array_distinct(every)).alias("f"))
        _analysed[asked] = row.first()["f"]
    return list(_analysed[asked])


def with_synonyms(words: Column | str, groups: Sequence[Sequence[str]] = SYNONYM_GROUPS) -> Column:
    """Query words, lower-case, plus all members of their synonym groups, without repeats.

    The groups are a short fixed list and become one map literal in the plan.
    """
    members: dict[str, list[str]] = {}
    for group in groups:
        names = [m.lower() for m in group]
        for name in names:
            members[name] = list(dict.fromkeys([*members.get(name, [name]), *names]))
    table = F.create_map(
        *[x for name, all_of in members.items()
          for x in (F.lit(name), F.array(*[F.lit(m) for m in all_of]))]
    )
    lowered = F.transform(_col(words), F.lower)
    found = F.transform(lowered, lambda w: F.coalesce(F.element_at(table, w), F.array(w)))
    return F.array_distinct(F.flatten(found))


def synonym_graph(words: Column | str, groups: Sequence[Sequence[str]] = SYNONYM_GROUPS) -> Column:
    """Alternatives per place of a query text, as an array of arrays of texts.

    At each word the longest run of words that a group names wins and stands for all members of its
    groups; other words stand for themselves. One fold over the words, with the groups as a map literal.
    """
    words = F.transform(_col(words), F.lower)
    members: dict[str, list[str]] = {}
    for group in groups:
        names = [" ".join(re.findall(r"[^\W_]+", m.lower())) for m in group]
        for name in names:
            members[name] = list(dict.fromkeys([*members.get(name, [name]), *names]))
    if not members:
        return F.transform(words, lambda w: F.array(w))
    table = F.create_map(*[x for name, every in members.items() for x in (F.lit(name), F.array(*[F.lit(m) for m in every]))])
    longest = max(len(name.split()) for name in members)
    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<array<string>>").alias("out"))

    def taken(state: Column, i: Column, n: int, found: Column) -> Column:
        return F.struct((i + n).alias("next"), F.concat(state["out"], F.array(found)).alias("out"))

    def step(state: Column, i: Column, of: Column) -> Column:
        choice = F.when(i < state["next"], state)
        for n in range(longest, 0, -1):
            found = F.element_at(table, F.array_join(F.slice(of, i + 1, n), " "))
            choice = choice.when((i + n <= F.size(of)) & found.isNotNull(), taken(state, i, n, found))
        return choice.otherwise(taken(state, i, 1, F.array(F.get(of, i))))

    def fold(of: Column) -> Column:
        places = F.transform(of, lambda _, i: i)
        return F.aggregate(places, start, lambda state, i: step(state, i, of), lambda state: state["out"])

    return let(words, fold)
