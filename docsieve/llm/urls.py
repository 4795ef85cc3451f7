"""URL filter: host and path rules and a list of URLs, behind a blocked Bloom filter.

Everything a URL could match, its canonical form and the pairs of a host suffix and a path prefix,
is hashed and put to the filter first. One 512-bit block answers a key, so a test touches one
cache line. Keys that pass go to an exact hash join, which removes the false positives.

The filter is built as a table of 64-bit words by ``bit_or`` and sent to all tasks. Its size
follows the list up to ``MAX_BYTES``; beyond, it lets more keys through and the join decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from docsieve.llm.common import let, lower_ascii, shipped, whole

MAX_BYTES = 16 << 20
BITS_PER_KEY = 12
PROBES = 6
# Parameters that only say where a visitor came from.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(whole(url), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(whole(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without closing slashes, other than tracking parameters in order."""
    query = F.regexp_extract(whole(url), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.concat(
        F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), "/+$", ""), tail
    )


def suffixes(host_name: Column, most: int) -> Column:
    """The host and its parent domains of at most ``most`` labels."""
    labels = F.split(host_name, r"\.")
    return let(labels, lambda x: F.transform(
        F.sequence(F.lit(1), F.least(F.size(x), F.lit(most))), lambda n: F.array_join(F.slice(x, -n, n), ".")
    ))


def prefixes(path_name: Column, most: int) -> Column:
    """Starts of the path that end in a slash, with at most ``most`` slashes."""
    parts = F.split(path_name, "/")
    return let(parts, lambda x: F.when(
        F.size(x) > 1,
        F.transform(F.sequence(F.lit(1), F.least(F.size(x) - 1, F.lit(most))),
                    lambda n: F.concat(F.array_join(F.slice(x, 1, n), "/"), F.lit("/"))),
    ).otherwise(F.array().cast("array<string>")))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key), F.xxhash64(key, F.lit(1))]


def bloom_words(keys: DataFrame, n: int, max_bytes: int = MAX_BYTES) -> np.ndarray:
    """The filter of ``keys(key)``, ``n`` of them, as 64-bit words, eight to a block."""
    blocks = max(1, min(n * BITS_PER_KEY // 512 + 1, max_bytes // 64))
    a, b = _hashes(F.col("key"))
    bit = lambda i: F.shiftrightunsigned(b, 9 * i).bitwiseAND(F.lit(511))
    probes = keys.select(
        F.pmod(a, F.lit(blocks)).alias("block"), F.explode(F.array(*[bit(i) for i in range(PROBES)])).alias("bit")
    )
    word = (F.col("block") * 8 + F.shiftright("bit", 6)).alias("word")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))
    rows = probes.groupBy(word).agg(F.bit_or(mask).alias("mask")).toArrow()
    words = np.zeros(blocks * 8, dtype=np.int64)
    words[rows.column("word").to_numpy()] = rows.column("mask").to_numpy()
    return words


def possible(keys: DataFrame, words: np.ndarray) -> DataFrame:
    """The rows of ``keys`` whose ``key`` passes the filter."""
    shipped(keys.sparkSession)
    shared = keys.sparkSession.sparkContext.broadcast(words)

    @pandas_udf("boolean")
    def passes(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        table = shared.value.view(np.uint64)
        for a, b in batches:
            base = np.mod(a.to_numpy(np.int64), len(table) // 8) * 8
            b = b.to_numpy(np.int64).view(np.uint64)
            ok = np.ones(len(base), dtype=bool)
            for i in range(PROBES):
                bit = (b >> np.uint64(9 * i)) & np.uint64(511)
                found = table[base + (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))
                ok &= (found & np.uint64(1)).astype(bool)
            yield pd.Series(ok)

    return keys.where(passes(*_hashes(F.col("key"))))


def judged(
    pages: DataFrame, url: str, rules: DataFrame, listed: DataFrame, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """(url, host, path, rule, verdict), one row per different url of ``pages``.

    ``rules(host, path, verdict)`` fit a host and its subdomains where the url's path starts with
    theirs, which must end in a slash; the longest rule wins, then the greater one. A url that no
    rule fits is blocked when its canonical form is in ``listed(key)``, else allowed. A null url
    or one without ``://`` has an empty host and path. With no rules and no list all is allowed.
    Other columns are not used.
    """
    table = rules.select(
        F.concat(F.lit("r"), "host", "path").alias("key"), F.concat("host", "path").alias("rule"), "verdict",
        F.size(F.split("host", r"\.")).alias("labels"), (F.size(F.split("path", "/")) - 1).alias("slashes"),
    )
    # What no rule has cannot be matched, so deeper hosts and paths need not be tried.
    deep = table.agg(F.max("labels"), F.max("slashes")).first()
    known = table.select("key", "rule", "verdict").unionByName(
        listed.select(
            F.concat(F.lit("c"), "key").alias("key"), F.lit(None).cast("string").alias("rule"),
            F.lit("block").alias("verdict"),
        ).distinct()
    )
    different = pages.select(pages[url].alias("url")).distinct()
    split = different.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    pairs = F.flatten(F.transform(
        suffixes(F.col("host"), deep[0] or 0) if deep[0] else F.array().cast("array<string>"),
        lambda s: F.transform(prefixes(F.col("path"), deep[1] or 0), lambda p: F.concat(F.lit("r"), s, p)),
    ))
    own = F.array(F.concat(F.lit("c"), canonical(F.col("url"))))
    tried = split.select("url", F.explode(F.concat(pairs, own)).alias("key"))
    hits = possible(tried, bloom_words(known.select("key"), known.count(), max_bytes)).join(known, "key")
    best = hits.groupBy(F.col("url").alias("_u")).agg(
        F.max(F.struct(F.col("rule").isNotNull().alias("r"), F.length("rule").alias("n"), "rule", "verdict")).alias("m")
    )
    return split.join(best, F.col("url").eqNullSafe(F.col("_u")), "left").select(
        "url", "host", "path", F.col("m.rule").alias("rule"), F.coalesce("m.verdict", F.lit("allow")).alias("verdict")
    )
