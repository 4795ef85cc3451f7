"""Spelling correction and infix suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsieve.functions.text import _col, tokenize

# The signatures are made for two edits and a shared first letter.
MAX_EDITS = 2
MIN_PREFIX = 1

_PIECES = MAX_EDITS + 1


def _piece_start(length: Column, piece: int) -> Column:
    return F.floor(length * piece / _PIECES).cast("int")


def _stored_signatures(term: Column) -> Column:
    """What follows a stored word's first letter is cut into three even pieces (if it has three letters).

    The first letters agree, so the edits are in the rest. Two edits can touch two pieces at most,
    so at least one of them occurs unchanged, and at most two places away, in any word within two
    edits (Li et al. 2011). Shorter words are few, as there are few of their length.
    """
    length = F.length(term) - MIN_PREFIX
    pieces = []
    for piece in range(_PIECES):
        start = _piece_start(length, piece)
        size = _piece_start(length, piece + 1) - start
        pieces.append(_signature(term, length, piece, F.substring(term, start + 1 + MIN_PREFIX, size)))
    return F.when(length >= _PIECES, F.array(*pieces)).otherwise(
        F.array(F.concat_ws(":", _prefix(term), F.lit("short")))
    )


def _query_signatures(term: Column) -> Column:
    """All pieces that a stored word within two edits could share with this word.

    With ``change`` the length difference, piece number i (from 0) only has to be looked for at
    shifts within i of its place from the left and within 2 - i from the right (Li et al. 2011).
    """
    own = F.length(term) - MIN_PREFIX
    out = [F.when(own < _PIECES + MAX_EDITS, F.concat_ws(":", _prefix(term), F.lit("short")))]
    for change in range(-MAX_EDITS, MAX_EDITS + 1):
        length = own - change
        for piece in range(_PIECES):
            start = _piece_start(length, piece)
            size = _piece_start(length, piece + 1) - start
            left, right = piece, MAX_EDITS - piece
            for shift in range(max(-left, change - right), min(left, change + right) + 1):
                at = start + shift
                fits = (length >= _PIECES) & (at >= 0) & (at + size <= own)
                found = _signature(term, length, piece, F.substring(term, at + 1 + MIN_PREFIX, size))
                out.append(F.when(fits, found))
    return F.array_distinct(F.filter(F.array(*out), lambda s: s.isNotNull()))


def _prefix(term: Column) -> Column:
    return F.substring(term, 1, MIN_PREFIX)


def _signature(term: Column, length: Column, piece: int, text: Column) -> Column:
    return F.concat_ws(
        ":", _prefix(term), length.cast("string"), F.lit(str(piece)), text
    )


def corrections(
    words: DataFrame,
    counts: DataFrame,
    documents: Column,
    most: int = 5,
    min_length: int = 3,
    max_frequency: float = 0.01,
    accuracy: float = 0.5,
) -> DataFrame:
    """Up to ``most`` stored terms per misspelt query word, best first.

    Words shorter than ``min_length`` and words that more than ``max_frequency`` of the documents
    hold are not corrected.

    ``words(word)`` are distinct query words, ``counts(term, frequency)`` the vocabulary and
    ``documents`` the number of documents. Candidates share the first letter, lie within two
    edits and keep similarity 1 - d / longest of at least ``accuracy``. Pairs come from an equi-join on
    shared pieces, which finds all of them without comparing every word with every term.
    """
    asked = words.where(F.length("word") >= min_length)
    left = asked.select("word", F.explode(_query_signatures(F.col("word"))).alias("signature"))
    right = counts.select(
        "term", "frequency", F.explode(_stored_signatures(F.col("term"))).alias("signature")
    )
    similarity = 1 - F.col("distance") / F.greatest(F.length("word"), F.length("term"))
    pairs = (
        left.join(right, "signature")
        .withColumn("distance", F.levenshtein("word", "term", MAX_EDITS))
        .where((F.col("distance") >= 0) & (similarity >= accuracy))
    )
    # A pair can share several pieces; one row per pair remains.
    unique = pairs.groupBy("word", "term").agg(
        F.first("frequency").alias("frequency"), F.first("distance").alias("distance")
    )
    # A stored word finds itself at distance 0 and so brings its own frequency along: the
    # vocabulary is needed once only. It is ranked first and leaves one more row to keep.
    order = Window.partitionBy("word").orderBy("distance", F.desc("frequency"), "term")
    best = unique.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= most + 1
    )
    own = F.max(F.when(F.col("distance") == 0, F.col("frequency"))).over(Window.partitionBy("word"))
    rank = F.col("place") - F.when(F.col("own").isNotNull(), 1).otherwise(0)
    return (
        best.withColumn("own", own)
        .withColumn("rank", rank)
        .where(F.col("distance") > 0)
        .where(F.coalesce("own", F.lit(0)) <= documents * max_frequency)
        .where(F.col("rank") <= most)
        .select("word", "rank", F.col("term").alias("suggestion"), "distance", "frequency")
    )


def suggest(
    df: DataFrame, entry: Column | str, typed: str, weight: Column | str, limit: int = 10
) -> DataFrame:
    """Distinct entries with a word that starts with the typed text, heaviest first."""
    hits = df.select(_col(entry).alias("suggestion"), _col(weight).alias("weight")).where(
        F.exists(F.transform(tokenize("suggestion"), F.lower), lambda w: w.startswith(typed.lower()))
    )
    best = hits.groupBy("suggestion").agg(F.max("weight").alias("weight"))
    return best.orderBy(F.desc("weight"), "suggestion").limit(limit)
