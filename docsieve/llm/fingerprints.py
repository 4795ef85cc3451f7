"""Document fingerprints: bottom-k sketches of word shingles.

A fingerprint is the k smallest different hashes of a text's shingles. Two of them merge into the
fingerprint of both texts together, and the share of the merged hashes that both hold estimates
how alike the texts are (Broder 1997). Hashes are 15 hexadecimal digits of MD5, written one after
the other, so that a fingerprint is plain text and any engine can make the same one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from docsieve.llm.common import held, let, lower_ascii, whole, words

K = 128
SHINGLE = 5
DIGITS = 15
BLOCK_ROWS = 2000
MAX_BLOCKS = 40_000


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The ``k`` smallest hashes of the text's shingles, in order; empty without words.

    Words are compared with A-Z lower-cased; fewer than ``shingle`` words are one shingle.
    """
    ws = words(lower_ascii(whole(text)))
    hashed = lambda parts: F.substring(F.md5(F.array_join(parts, " ")), 1, DIGITS)

    def of(w: Column) -> Column:
        last = F.greatest(F.size(w) - shingle, F.lit(0))
        each = F.transform(F.sequence(F.lit(0), last), lambda i: hashed(F.slice(w, i + 1, shingle)))
        return F.when(F.size(w) > 0, each).otherwise(F.array().cast("array<string>"))

    return F.slice(F.array_sort(F.array_distinct(let(ws, of))), 1, k)


def as_text(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def from_text(fingerprint: Column) -> Column:
    """The hashes of a fingerprint."""
    return F.regexp_extract_all(fingerprint, F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both texts' shingles together."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of the shingle sets, 0 to 1; two empty sets are alike, one is not."""
    both = let(merged(a, b, k), lambda m: F.size(F.array_intersect(F.array_intersect(m, a), b)) / F.size(m))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(
        (F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)
    ).otherwise(both)


def distinct_shingles(hashes: Column, k: int = K) -> Column:
    """Estimated number of different shingles: exact below ``k``, else (k - 1) / the k-th hash as a share."""
    top = F.conv(F.get(hashes, F.lit(k - 1)), 16, 10).cast("double") / float(16**DIGITS)
    return F.when(F.size(hashes) < k, F.size(hashes).cast("double")).otherwise((k - 1) / top)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds, from the likeness and the two set sizes."""
    r, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(na == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r * (na + nb) / ((1 + r) * na)))


def _block_starts(docs: DataFrame, key: str, rows: int) -> list:
    """Keys that begin blocks of about ``rows`` rows in descending order; the first is the largest key."""
    n = docs.count()
    blocks = max(1, min(n // rows, MAX_BLOCKS))
    shares = [i / blocks for i in range(blocks, 0, -1)]
    found = docs.agg(F.percentile_approx(key, shares, 20 * blocks)).first()[0] or []
    return sorted(set(found), reverse=True)


def _block(key: Column, starts: list) -> Column:
    """Number of the key's block: how many starts lie above it, less one; found in two steps."""
    if not starts:
        return F.lit(0)
    step = max(1, int(len(starts) ** 0.5))
    above = lambda among: F.size(F.filter(among, lambda s: key.isNull() | (s >= key)))
    numbers = lambda values: F.array(*[F.lit(v) for v in values])
    groups = [starts[i : i + step] for i in range(0, len(starts), step)]
    coarse = above(numbers([g[0] for g in groups])) - 1
    inner = F.get(F.array(*[numbers(g) for g in groups]), coarse)
    return let(coarse, lambda c: c * step + above(inner) - 1)


def in_order(docs: DataFrame, key: str, text: str, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, WindowSpec]:
    """(key, text, block, guest) and the window in which the next row is the next document.

    Order is by descending key, null keys last, rows of one key by a hash of their text. A block
    also holds the first rows of the block after it as guests, and the last block those of the
    first, so every row finds its successor in its own block and a text crosses the network once.
    """
    rows = docs.select(docs[key].alias("key"), whole(docs[text]).alias("text"))
    starts = _block_starts(rows, "key", block_rows)
    own = held(rows, block=_block(F.col("key"), starts).cast("int"))
    first = F.col("key").isin(starts) if len(starts) <= 2 else F.array_contains(
        F.array(*[F.lit(s) for s in starts]), F.col("key")
    )
    before = F.pmod(F.col("block") - 1, F.lit(max(1, len(starts))))
    seats = F.when(
        first, F.array(F.struct(F.col("block").alias("block"), F.lit(False).alias("guest")),
                       F.struct(before.alias("block"), F.lit(True).alias("guest")))
    ).otherwise(F.array(F.struct(F.col("block").alias("block"), F.lit(False).alias("guest"))))
    seated = own.select("key", "text", F.inline(seats))
    order = Window.partitionBy("block").orderBy("guest", F.desc_nulls_last("key"), F.xxhash64("text"))
    return seated, order


def edited_pairs(docs: DataFrame, key: str, text: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(key, n_chars, own, edited, next): sketches' inputs side by side.

    ``own`` is the text's sketch, ``next`` that of the following document in descending key order
    (after the last, the first), ``edited`` the text whose last floor(n/2) characters are replaced
    by the first as many of the following one, or all it has. Null texts are empty. Null keys come
    last; rows of one key follow each other by a hash of their text. A single document follows
    itself. Where all keys are null nothing follows the last. Keys must be numbers or dates; other
    columns are not used; an empty table gives no rows.
    """
    seated, order = in_order(docs, key, text, block_rows)
    sketched = held(seated, own=sketch(F.col("text")))
    paired = sketched.select(
        "key", "text", "own", "guest",
        F.lead("text").over(order).alias("next_text"), F.lead("own").over(order).alias("next"),
    ).where("NOT guest")
    half = "cast(floor(length(text) / 2) as int)"
    edited = F.concat(
        F.expr(f"substring(text, 1, length(text) - {half})"),
        F.coalesce(F.expr(f"substring(next_text, 1, {half})"), F.lit("")),
    )
    none = F.array().cast("array<string>")
    return paired.select(
        "key", F.length("text").cast("long").alias("n_chars"), "own", edited.alias("edited"),
        F.coalesce("next", none).alias("next"),
    )
