"""Similarity join on sets of word shingles: exact Jaccard links, as components.

Texts with equal sets are one node. A node's prefix is its rarest shingles, as many as a set must
share one of with any set that is similar enough. Rarity comes from counters over all texts; they
only choose the order, so that common shingles are in few prefixes, and any order is exact.

Nodes meet in tiles of one shingle and one band of set sizes. There, parity bitmaps (every shingle
flips one bit) bound the overlap from above, as each bit that differs is a shingle of one side
alone. What is left is decided by intersecting the sorted arrays.

Two rounds keep groups of near copies, who share most of their tiles, from being compared again
and again. Round one takes some tiles of each node, pairs each node with the smallest of its tile
and settles the groups that come out, each array sent once; then groups that still meet in a tile are
tried with one promising pair of each two. Round two takes all tiles, drops those whose nodes are
together already, and compares what is still apart. The second round alone makes the result
exact; the first makes it cheap. Tiles of one node are dropped before both, behind a
Bloom filter of bounded size, so that what is joined follows the copies, not the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsieve.llm.common import held, let, lower_ascii, shingle_hashes, shipped, whole, words, written
from docsieve.llm.components import components
from docsieve.llm.urls import bloom_words, possible

COUNTERS = 1 << 19
FIRST_TILES = 6  # tiles of a node that round one uses, about
PIVOT_TURNS = 2
TILE_ROWS = 2000
COARSE_WORDS = 8


def shingle_set(text: Column, k: int) -> Column:
    """The different hashes of windows of ``k`` words, sorted. A-Z are lower-cased."""
    return F.sort_array(F.array_distinct(let(words(lower_ascii(whole(text))), lambda w: shingle_hashes(w, k))))


def text_hash(text: Column) -> Column:
    return F.xxhash64(whole(text))


def _sets(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    name = F.coalesce(docs[key].cast("string"), F.lit(""))
    rows = docs.select(docs[key].alias("key"), name.alias("rep"), docs[text].alias("_t"))
    return held(rows, arr=shingle_set(F.col("_t"), k)).withColumn("text_hash", text_hash(F.col("_t"))).drop("_t")


def needed_overlap(n: np.ndarray | int, m: np.ndarray | int, percent: int):
    """The smallest intersection that links sets of these sizes: 100 i >= percent (n + m - i)."""
    return -(-percent * (np.asarray(n) + np.asarray(m)) // (100 + percent))


def bits_of(n: int) -> int:
    """Bits of a bitmap: a power of two, twice the set size at least, so that sizes differ by bands."""
    return max(64 * COARSE_WORDS, 1 << (max(n, 1) - 1).bit_length() + 1)


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Parity of the shingles that fall on each bit, as 64-bit words."""
    bits = bits_of(len(hashes))
    counts = np.bincount((hashes.view(np.uint64) >> np.uint64(7)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.uint64)


def differing(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Bits that differ between a bitmap and rows of bitmaps; the wider ones are folded, parity stays."""
    while len(one) > many.shape[1]:
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    while many.shape[1] > len(one):
        many = many[:, : many.shape[1] // 2] ^ many[:, many.shape[1] // 2 :]
    return np.bitwise_count(many ^ one).sum(axis=1)


def coarse(bits: np.ndarray) -> np.ndarray:
    """A bitmap folded to ``COARSE_WORDS`` words; parity stays, so its bound holds."""
    while len(bits) > COARSE_WORDS:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _counters(sets: DataFrame, counters: int) -> np.ndarray:
    slots = sets.select(F.explode("arr").alias("h")).groupBy(F.pmod("h", F.lit(counters)).alias("slot"))
    table = slots.agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros(counters, dtype=np.int64)
    counts[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    return counts


def prefixes(sets: DataFrame, percent: int, counters: int) -> DataFrame:
    """(key, text_hash, rep, node, n, bits, coarse, prefix) of every text with a word."""
    sets = sets.where("size(arr) > 0")
    shared = sets.sparkSession.sparkContext.broadcast(_counters(sets, counters))
    key_type = sets.schema["key"].dataType.simpleString()

    def reduce_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            column = batch.column("arr")
            offsets = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False)
            n, bits, folded, prefix = np.diff(offsets), [], [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                s = values[a:b]
                full = bitmap(s)
                bits.append(full.tobytes())
                folded.append(coarse(full).tobytes())
                most = (b - a) - -(-percent * (b - a) // 100) + 1
                order = np.lexsort((s, counts[np.mod(s, counters)]))[:most]
                prefix.append(s[order])
            lists = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32), np.concatenate(prefix)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("text_hash"), batch.column("rep"), batch.column("node"), pa.array(n, pa.int32()),
                 pa.array(bits, pa.binary()), pa.array(folded, pa.binary()), lists],
                ["key", "text_hash", "rep", "node", "n", "bits", "coarse", "prefix"],
            )

    return sets.withColumn("node", F.xxhash64("arr")).mapInArrow(
        reduce_, f"key {key_type}, text_hash long, rep string, node long, n int, bits binary, coarse binary, prefix array<long>"
    )


def tiles(nodes: DataFrame, percent: int) -> DataFrame:
    """(tile, band, node): a node is in the tiles of its prefix and its size band, and in those of
    the next band where a set of that band can be similar to it."""
    band = F.floor(F.log2("n") + 1e-9).cast("int")
    reaches = F.col("n") * 100 >= percent * F.pow(F.lit(2.0), band + 1)
    bands = F.when(reaches, F.array(band, band + 1)).otherwise(F.array(band))
    met = nodes.select("node", bands.alias("bands"), F.explode("prefix").alias("token"))
    met = met.select("node", "token", F.explode("bands").alias("band"))
    return met.select(F.xxhash64("token", "band").alias("tile"), "band", "node")


def shared_tiles(nodes: DataFrame, percent: int) -> DataFrame:
    """``tiles`` that hold two nodes or more."""
    every = tiles(nodes, percent)
    several = every.groupBy("tile").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    several = written(several.select("tile"), "several")
    words_ = bloom_words(several.select(F.col("tile").alias("key")), several.count())
    near = possible(every.withColumn("key", F.col("tile")), words_).drop("key")
    return near.join(several, "tile", "left_semi")


def _similar(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b)`` whose sizes and bitmaps allow a link, with ``room``: how far above the need they may reach."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            differ = np.array([
                differing(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)[None])[0]
                for x, y in zip(batch.column("bitsa"), batch.column("bitsb"))
            ], dtype=np.int64)
            na, nb = na.astype(np.int64), nb.astype(np.int64)
            room = np.minimum((na + nb - differ) // 2, np.minimum(na, nb)) - needed_overlap(na, nb, percent)
            rows = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(room)], ["a", "b", "room"])
            yield rows.filter(pa.array(room >= 0))

    return joined.select("a", "b", "na", "nb", "bitsa", "bitsb").mapInArrow(keep, "a long, b long, room long")


def _verified(docs: DataFrame, key: str, text: str, k: int, percent: int, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs(a, b)`` whose sets are similar enough, by their arrays."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    found = written(_arrays(docs, key, text, k, ends.join(nodes.select("node", "rep"), "node")), "pair_arrays")
    side = lambda x: found.select(F.col("node").alias(x), F.col("arr").alias(f"arr{x}"))
    shared = F.size(F.array_intersect("arra", "arrb"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(
        shared * 100 >= percent * (F.size("arra") + F.size("arrb") - shared)
    ).select("a", "b")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _by_pivots(members: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs (a, b), for two groups that meet in a tile the most promising of each tile's pivot and the others.

    The pivot is drawn by hash, another one each turn. One link joins two groups, so one pair of
    each two groups is enough here.
    """
    labelled = _labelled(members, labels)
    pivots = labelled.groupBy("tile").agg(
        F.min_by(F.struct("node", "root"), F.xxhash64("node", F.lit(turn))).alias("p"),
        F.min("root").alias("lo"), F.max("root").alias("hi"),
    ).where("lo < hi").select("tile", F.col("p.node").alias("a"), F.col("p.root").alias("ra"))
    met = labelled.join(pivots, "tile").where("root <> ra").select(
        "a", F.col("node").alias("b"), F.least("root", "ra").alias("lo"), F.greatest("root", "ra").alias("hi")
    ).distinct()
    met = written(met, "pivot_pairs")
    near = _similar(met.select("a", "b"), nodes, percent)
    best = met.join(near, ["a", "b"]).groupBy("lo", "hi").agg(F.max_by(F.struct("a", "b"), "room").alias("p"))
    return written(best.select("p.a", "p.b"), "best_pairs")


def _arrays(docs: DataFrame, key: str, text: str, k: int, wanted: DataFrame) -> DataFrame:
    """``wanted(node, rep, ...)`` with ``arr``. A Bloom filter of the names keeps other texts where they are."""
    named = docs.select(docs[key].alias("key"), docs[text].alias("text"),
                        F.coalesce(docs[key].cast("string"), F.lit("")).alias("rep"))
    filters = bloom_words(wanted.select(F.col("rep").alias("key")), wanted.count())
    near = possible(named.withColumn("key", F.col("rep")), filters).select("rep", "text")
    met = held(near.join(wanted, "rep"), arr=shingle_set(F.col("text"), k))
    return met.where(F.xxhash64("arr") == F.col("node")).drop("text", "rep")


def links_in_tile(nodes: np.ndarray, arrays: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join everything similar in the tile; pairs already joined through others are skipped."""
    sizes = np.array([len(x) for x in arrays])
    order = np.argsort(sizes, kind="stable")
    nodes, arrays, sizes = nodes[order], [arrays[i] for i in order], sizes[order]
    maps = [bitmap(x) for x in arrays]
    group = np.arange(len(nodes))
    found = []
    # Bitmaps of one width lie together, as the sizes are in order.
    starts = np.flatnonzero(np.r_[True, [len(a) != len(b) for a, b in zip(maps, maps[1:])]]) if len(maps) else []
    runs = [(a, b, np.stack(maps[a:b])) for a, b in zip(starts, [*starts[1:], len(maps)])]
    for i in range(1, len(nodes)):
        low = np.searchsorted(sizes[:i], -(-percent * sizes[i] // 100))
        for a, b, stacked in runs:
            a0, b0 = max(a, low), min(b, i)
            if a0 >= b0:
                continue
            apart = a0 + np.flatnonzero(group[a0:b0] != group[i])
            if not len(apart):
                continue
            differ = differing(maps[i], stacked[apart - a])
            need = needed_overlap(sizes[apart], sizes[i], percent)
            for j in apart[(sizes[apart] + sizes[i] - differ) // 2 >= need]:
                if group[j] == group[i]:
                    continue
                shared = len(np.intersect1d(arrays[i], arrays[j], assume_unique=True))
                if shared >= needed_overlap(sizes[i], sizes[j], percent):
                    found.append((int(nodes[i]), int(nodes[j])))
                    group[group == group[i]] = group[j]
    return found


def _settle(docs, key, text, k, percent, nodes: DataFrame, groups: DataFrame, tile_rows: int) -> DataFrame:
    """Links (a, b) inside ``groups(node, root)``; groups above ``tile_rows`` are cut, each part with the root."""
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    parts = F.ceil(F.col("members") / tile_rows)
    placed = groups.join(sizes, "root").select(
        "node", "root",
        F.when(F.col("node") == F.col("root"), F.sequence(F.lit(0).cast("long"), parts - 1))
        .otherwise(F.array(F.pmod("node", parts))).alias("parts"),
    )
    wanted = written(placed.join(nodes.select("node", "rep"), "node"), "members")
    rows = _arrays(docs, key, text, k, wanted).select("node", "root", F.explode("parts").alias("part"), "arr")

    def link(table: pa.Table) -> pa.Table:
        column = table.column("arr").combine_chunks()
        offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        arrays = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        found = links_in_tile(table.column("node").to_numpy(), arrays, percent)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return rows.groupBy("root", "part").applyInArrow(link, "a long, b long")


def _apart(members: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int, tile_rows: int) -> DataFrame:
    """Pairs (a, b) of nodes that share a tile, are not together yet, and whose bitmaps allow a link."""
    labelled = _labelled(members, labels)
    mixed = labelled.groupBy("tile").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    met = written(labelled.join(mixed.select("tile"), "tile", "left_semi"), "mixed_tiles")
    # The largest side of a tile is cut into parts; the rest meets each part, and its own parts pairwise.
    sides = met.groupBy("tile", "root").agg(F.count(F.lit(1)).alias("c"))
    whole_tiles = sides.groupBy(F.col("tile").alias("t")).agg(
        F.max_by("root", F.struct("c", "root")).alias("main"), F.max("c").alias("most"), F.sum("c").alias("all")
    )
    cut = lambda c: F.greatest(F.ceil(c / F.lit(tile_rows)), F.lit(1))
    sized = met.join(whole_tiles, F.col("tile") == F.col("t")).select(
        "tile", "node", "root", (F.col("root") == F.col("main")).alias("is_main"),
        cut(F.col("most")).alias("mains"), cut(F.col("all") - F.col("most")).alias("others"),
    )
    own = F.pmod("node", F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others")))
    all_of = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    name = lambda kind, i, j: F.xxhash64("tile", F.lit(kind), i, j)
    sized = sized.withColumn("own", own)
    spots = F.when(
        F.col("is_main"), F.transform(all_of(F.col("others")), lambda i: name("m", i, F.col("own")))
    ).otherwise(F.concat(
        F.transform(all_of(F.col("mains")), lambda j: name("m", F.col("own"), j)),
        F.transform(F.filter(all_of(F.col("others")), lambda j: j != F.col("own")),
                    lambda j: name("o", F.least(j, F.col("own")), F.greatest(j, F.col("own")))),
    ))
    spread = sized.select("node", "root", F.explode(spots).alias("spot"))
    spread = spread.join(nodes.select("node", "n", "coarse"), "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_back = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held_back is not None:
                table = pa.concat_tables([held_back, table])
            spot = table.column("spot").to_numpy()
            cut_at = int(np.searchsorted(spot, spot[-1])) if len(spot) else 0
            held_back = table.slice(cut_at)
            if cut_at:
                yield _pairs_of(table.slice(0, cut_at), percent)
        if held_back is not None and held_back.num_rows:
            yield _pairs_of(held_back, percent)

    ordered = spread.select("spot", "node", "root", "n", "coarse").repartition("spot").sortWithinPartitions("spot")
    found = ordered.mapInArrow(compare, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _pairs_of(table: pa.Table, percent: int) -> pa.RecordBatch:
    """Pairs within the spots of sorted rows, neighbours first, then rows two apart, and so on."""
    spot, node, root, n = (table.column(c).to_numpy() for c in ("spot", "node", "root", "n"))
    n = n.astype(np.int64)
    data = table.column("coarse").combine_chunks()
    start = np.frombuffer(data.buffers()[1], np.int32)[data.offset]
    bits = np.frombuffer(data.buffers()[2], np.uint64)[start // 8 : start // 8 + len(n) * COARSE_WORDS].reshape(len(n), -1)
    a, b = [], []
    i, lag = np.arange(len(n) - 1), 1
    while len(i):
        i = i[i + lag < len(n)]
        i = i[spot[i] == spot[i + lag]]
        j = i + lag
        need = needed_overlap(n[i], n[j], percent)
        ok = (root[i] != root[j]) & (np.minimum(n[i], n[j]) >= need)
        x, y, need = i[ok], j[ok], need[ok]
        ok = (n[x] + n[y] - np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1)) // 2 >= need
        a.append(node[x[ok]])
        b.append(node[y[ok]])
        lag += 1
    none = [np.empty(0, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a or none)), pa.array(np.concatenate(b or none))], ["a", "b"])


def near_groups(
    docs: DataFrame,
    key: str,
    text: str,
    k: int = 5,
    percent: int = 80,
    counters: int = COUNTERS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(key, text_hash, n_shingles, component_id), one row per row of ``docs``.

    Rows link when 100 * intersection >= ``percent`` * union of their shingle sets. A text of
    fewer than ``k`` words is one shingle; null, empty and blank texts have no shingle and link
    with nothing. ``component_id`` is the smallest key that can be reached, the row's own
    included; null keys are never the smallest, and a group of null keys alone has null. Repeated
    rows and rows of one key with different texts are rows of their own. Other columns are not
    used; an empty table gives no rows. Shingles are compared as 64-bit hashes.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be 50 to 100: sizes further apart would not meet")
    shipped(docs.sparkSession)
    sets = _sets(docs, key, text, k)
    rows = written(prefixes(sets, percent, counters), "sets")
    nodes = rows.groupBy("node").agg(
        F.min("rep").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"),
        F.first("coarse").alias("coarse"), F.first("prefix").alias("prefix"),
    )
    nodes = written(nodes, "nodes")
    members = written(shared_tiles(nodes, percent), "tiles")

    # A node has about (1 - percent / 100) * 2 ** band tiles.
    stride = F.greatest(F.floor(F.pow(F.lit(2.0), "band") * (100 - percent) / (100 * FIRST_TILES)), F.lit(1))
    first = members.where(F.pmod("tile", stride) == 0).select("tile", "node")
    least = first.groupBy("tile").agg(F.min("node").alias("a"), F.max("node").alias("hi")).where("a < hi").drop("hi")
    stars = first.join(least, "tile").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    groups = written(components(_similar(stars, nodes, percent).select("a", "b")), "groups")
    links = written(_settle(docs, key, text, k, percent, nodes, groups, tile_rows), "links")
    labels = written(components(links), "labels")
    members = members.select("tile", "node")
    as_edges = lambda found: found.select(F.col("node").alias("a"), F.col("root").alias("b"))
    for turn in range(PIVOT_TURNS):
        tried = _verified(docs, key, text, k, percent, nodes, _by_pivots(members, labels, nodes, percent, turn))
        labels = written(components(as_edges(labels).unionByName(tried)), "labels")

    open_pairs = _apart(members, labels, nodes, percent, tile_rows)
    open_pairs = written(_similar(open_pairs, nodes, percent).select("a", "b"), "open_pairs")
    more = _verified(docs, key, text, k, percent, nodes, open_pairs)
    roots = written(components(as_edges(labels).unionByName(more)), "roots")

    placed = rows.select("key", "text_hash", "n", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy(F.col("root").alias("_r")).agg(F.min("key").alias("component_id"))
    linked = placed.join(smallest, F.col("root") == F.col("_r")).select(
        "key", "text_hash", F.col("n").cast("long").alias("n_shingles"), "component_id"
    )
    alone = docs.where(~F.coalesce(docs[text].cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).select(
        docs[key].alias("key"), text_hash(docs[text]).alias("text_hash"), F.lit(0).cast("long").alias("n_shingles"), docs[key].alias("component_id")
    )
    return linked.unionByName(alone)

