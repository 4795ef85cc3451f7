"""The prefix trie of conversations, shard by shard as balanced parentheses.

A turn is a 16-byte digest of role and text, a conversation the string of its turns' digests. Sorted
by that string, the conversations below a node of the trie follow each other. Runs of them are shards.
A shard's trie is written as balanced parentheses, one pair a node, in the order of the sort. Where a
node ends is the first place behind it whose excess falls below its own, found through the smallest
excess of blocks of parentheses and of pairs of such blocks (a range min-max tree). Between the two
places lie the node's subtree, its leaves (pairs "()") and, by differences of cumulative arrays, the
members, bytes and savings.

Only nodes on the path of a shard's first or last conversation (its spines) can go on in another shard.
Their figures are sums over what is theirs alone; one pass over the spines of all shards, two paths a
shard, adds up equal nodes with a stack and hands the sums up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsieve.llm.common import shipped, whole, written

DIGEST = 16
BLOCK = 64  # parentheses in a block of the range min-max tree
SHARD_TURNS = 200_000
ENDS_CHARS = 1 << 20
LABEL_LIMIT = 1 << 40


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that name role and text; null counts as empty."""
    role, text = whole(role), whole(text)
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def find_close(excess: np.ndarray, opens: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """For each opening place, the first later place whose excess is below its own."""
    n = len(excess)
    n_blocks = -(-n // block)
    padded = np.full(n_blocks * block, np.iinfo(np.int32).max, dtype=np.int32)
    padded[:n] = excess
    grid = padded.reshape(n_blocks, block)
    levels = [grid.min(axis=1)]
    while len(levels[-1]) > 1:
        low = levels[-1]
        if len(low) % 2:
            low = levels[-1] = np.append(low, np.iinfo(np.int32).max)
        levels.append(low.reshape(-1, 2).min(axis=1))
    target = excess[opens] - 1
    out = np.full(len(opens), -1, dtype=np.int64)
    columns = np.arange(block)

    def inside(which: np.ndarray, blocks: np.ndarray, after: np.ndarray) -> None:
        for a in range(0, len(which), 1 << 15):
            some, b = which[a : a + (1 << 15)], blocks[a : a + (1 << 15)]
            hit = (grid[b] <= target[some, None]) & (columns > after[a : a + (1 << 15), None])
            found = hit.any(axis=1)
            out[some[found]] = b[found] * block + hit[found].argmax(axis=1)

    every = np.arange(len(opens))
    inside(every, opens // block, opens % block)
    open_yet = every[out < 0]
    # Up to the first right-hand neighbour that falls low enough, then down to its first such block.
    node, height = opens[open_yet] // block, np.full(len(open_yet), -1)
    for level in range(len(levels) - 1):
        going = height < 0
        left = going & (node % 2 == 0)
        beside = np.minimum(node + 1, len(levels[level]) - 1)
        falls = left & (levels[level][beside] <= target[open_yet])
        height[falls] = level
        node = np.where(falls, node + 1, np.where(going, node // 2, node))
    for level in range(len(levels) - 1, 0, -1):
        down = height >= level
        child = node * 2
        child = child + (levels[level - 1][np.minimum(child, len(levels[level - 1]) - 1)] > target[open_yet])
        node = np.where(down, child, node)
    inside(open_yet, node, np.full(len(open_yet), -1))
    return out


class Shard:
    """Figures of the nodes of one run of sorted conversations, numbered in the order of the sort."""

    def __init__(self, ids: np.ndarray, paths: list[bytes], sizes: list[np.ndarray], block: int = BLOCK):
        n = np.array([len(p) // DIGEST for p in paths], dtype=np.int64)
        shared = np.zeros(len(paths), dtype=np.int64)
        for i in range(1, len(paths)):
            shared[i] = common_turns(paths[i - 1], paths[i])
        fresh = n - shared
        fresh[0] += 1  # the root
        total = int(fresh.sum())
        # One pair a node: each conversation closes what it does not share, then opens its own.
        closes = np.append(0, n[:-1] - shared[1:])
        signs = np.repeat(np.tile([-1, 1], len(n)), np.stack([closes, fresh], axis=1).ravel()).astype(np.int8)
        signs = np.append(signs, np.full(n[-1] + 1, -1, dtype=np.int8))
        excess = np.cumsum(signs, dtype=np.int32)
        opens = np.flatnonzero(signs == 1)
        close = find_close(excess, opens, block)
        self.depth = excess[opens].astype(np.int64) - 1
        self.size = (close - opens + 1) // 2
        pairs = np.append(0, np.cumsum((signs[:-1] == 1) & (signs[1:] == -1)))
        self.leaf = (close - opens) == 1
        self.leaves = pairs[close] - pairs[opens]
        # A node's parent is the last earlier node one level up.
        by_level = np.argsort(self.depth, kind="stable")
        keys = self.depth[by_level] * np.int64(total) + by_level
        number = np.arange(total)
        self.parent = by_level[np.searchsorted(keys, (self.depth - 1) * np.int64(total) + number) - 1]
        self.parent[0] = -1
        # Where conversations end, and the members below a node.
        last = np.cumsum(fresh) - 1
        along: list[int] = []
        end = np.empty(len(n), dtype=np.int64)
        for i in range(len(n)):
            keep = shared[i] + (i > 0)
            del along[keep:]
            along.extend(range(int(last[i] - fresh[i] + 1), int(last[i]) + 1))
            end[i] = along[-1]
            if i == 0:
                self.left = list(along)
        self.right = list(along)
        ended = np.append(0, np.cumsum(np.bincount(end, minlength=total)))
        self.n = ended[number + self.size] - ended[number]
        starts = ended[number]
        bounds = np.stack([starts, starts + self.n], axis=1).ravel()
        self.least = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), bounds)[::2]
        self.own_ends = ended[number + 1] - ended[number]
        self.first_end = starts
        self.bytes = np.zeros(total, dtype=np.int64)
        of = np.repeat(np.arange(len(n)), fresh)
        flat = np.concatenate(sizes)
        offset = np.append(0, np.cumsum(n))[:-1]
        real = self.depth > 0
        self.bytes[real] = flat[offset[of[real]] + self.depth[real] - 1]
        self.ids, self.paths, self.of, self.total = ids, paths, of, total

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sums of ``values`` over each node's subtree."""
        sums = np.append(0, np.cumsum(values))
        number = np.arange(self.total)
        return sums[number + self.size] - sums[number]

    def ends(self, node: int) -> str:
        a = int(self.first_end[node])
        return ",".join(map(str, self.ids[a : a + int(self.own_ends[node])].tolist()))


def common_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    differ = np.flatnonzero(x != y) if n > 256 else [i for i in range(n) if a[i] != b[i]][:1]
    return (int(differ[0]) if len(differ) else n) // DIGEST


NODE = (
    "shard long, slot int, conv_id long, depth long, parent_id long, parent_slot int, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, digest binary, text_bytes long, ends string, piece int"
)
_NAMES = [part.split()[0] for part in NODE.split(", ")]
_TYPES = {"string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}
_KINDS = [_TYPES[part.split()[1]] for part in NODE.split(", ")]


def _column(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def _batch(columns: dict) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [_column(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(_NAMES, _KINDS)], _NAMES
    )


def shard_rows(number: int, shard: Shard) -> Iterator[pa.RecordBatch]:
    """A row per node; nodes of the spines, which have a ``slot``, come with what is theirs alone.

    A spine node's member list follows in pieces, a row each.
    """
    slots = {node: i for i, node in enumerate(dict.fromkeys([*shard.left, *shard.right]))}
    spine = np.zeros(shard.total, dtype=bool)
    spine[list(slots)] = True
    slot = np.full(shard.total, -1, dtype=np.int32)
    slot[list(slots)] = list(slots.values())
    up = np.where(shard.parent >= 0, slot[shard.parent], -1)
    private = ~spine
    children = np.bincount(shard.parent[1:][private[1:]], minlength=shard.total)
    leaves = shard.below((shard.leaf & private).astype(np.int64))
    saved = shard.below(np.where(private, (shard.n - 1) * shard.bytes, 0))
    # What a spine node holds through a spine node below it is handed up later.
    lower = np.array([node for node in slots if node], dtype=np.int64)
    for sums in (leaves, saved):
        np.subtract.at(sums, shard.parent[lower], sums[lower])
    empty = hashlib.sha256(b"").hexdigest()
    sha = [empty] * shard.total
    for node in np.flatnonzero((shard.own_ends > 0) & private).tolist():
        sha[node] = hashlib.sha256(shard.ends(node).encode()).hexdigest()
    keys: list[bytes | None] = [None] * shard.total
    for node in slots:
        d = int(shard.depth[node])
        keys[node] = shard.paths[int(shard.of[node])][(d - 1) * DIGEST : d * DIGEST] if d else b""
    none = lambda values, gone: pa.array(values, mask=gone)
    yield _batch({
        "shard": np.full(shard.total, number), "slot": none(slot, private), "conv_id": shard.least, "depth": shard.depth,
        "parent_id": none(shard.least[shard.parent], shard.parent < 0), "parent_slot": none(up.astype(np.int32), up < 0),
        "n_convs": shard.n, "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
        "ends_sha256": none(np.array(sha, dtype=object), spine), "digest": keys, "text_bytes": shard.bytes,
    })
    for node, i in slots.items():
        text = shard.ends(node)
        pieces = [text[a : a + ENDS_CHARS] for a in range(0, len(text), ENDS_CHARS)]
        if pieces:
            yield _batch({
                "shard": [number] * len(pieces), "slot": [i] * len(pieces), "ends": pieces, "piece": list(range(len(pieces))),
            })


def shards(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Node rows of ``paths(conv_id, path, sizes)``, sorted and cut into runs of about ``shard_turns`` turns."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * LABEL_LIMIT
        ids, keys, sizes, turns = [], [], [], 0
        for batch in batches:
            for c, path, size in zip(batch.column("conv_id").to_pylist(), batch.column("path").to_pylist(), batch.column("sizes")):
                ids.append(c)
                keys.append(path)
                sizes.append(size.values.to_numpy(zero_copy_only=False))
                turns += len(path) // DIGEST + 1
                if turns >= shard_turns:
                    yield from shard_rows(number, Shard(np.array(ids, dtype=np.int64), keys, sizes))
                    number, ids, keys, sizes, turns = number + 1, [], [], [], 0
        if ids:
            yield from shard_rows(number, Shard(np.array(ids, dtype=np.int64), keys, sizes))

    # The smaller id comes first among equal conversations, and parts a large group of copies.
    return paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(cut, NODE)


class _Open:
    """A spine node while shards that hold it go by."""

    def __init__(self, digest: bytes, depth: int, size: int, parent: int):
        self.digest, self.depth, self.size, self.parent = digest, depth, size, parent
        self.least, self.n, self.children, self.leaves, self.saved = 1 << 63, 0, 0, 0, 0
        self.sha, self.some = hashlib.sha256(), False


SPINE = (
    "shard long, slot int, node long, conv_id long, depth long, parent_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, head boolean"
)


def merged_spines(rows: DataFrame) -> DataFrame:
    """(shard, slot, node and its final figures; ``head`` once a node) from the spine rows of all shards.

    One task sees two paths a shard, in the order of the sort, and the members that end on them piece by
    piece. A node is complete when a shard comes whose spine does not hold it.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[_Open] = []
        stack: list[int] = []
        uses: list[tuple[int, int, int]] = []
        here: dict[int, int] = {}  # slot of the shard at hand -> node
        at = None

        def finish(keep: int) -> None:
            while len(stack) > keep:
                node = nodes[stack.pop()]
                node.leaves += node.children == 0
                node.saved += (node.n - 1) * node.size
                if stack:
                    up = nodes[stack[-1]]
                    up.children += 1
                    up.leaves += node.leaves
                    up.saved += node.saved

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != at:
                    at, here = row["shard"], {}
                slot = row["slot"]
                if row["ends"] is not None:
                    node = nodes[here[slot]]
                    if node.some and row["piece"] == 0:
                        node.sha.update(b",")
                    node.sha.update(row["ends"].encode())
                    node.some = True
                    continue
                depth = row["depth"]
                # Slots come from the top down: first the first conversation's path, then the rest of the last one's.
                goes_on = len(stack) > depth and nodes[stack[depth]].digest == row["digest"]
                if not goes_on:
                    finish(depth)
                    nodes.append(_Open(row["digest"], depth, row["text_bytes"], stack[-1] if stack else -1))
                    stack.append(len(nodes) - 1)
                node = nodes[stack[depth]]
                node.least = min(node.least, row["conv_id"])
                node.n += row["n_convs"]
                node.children += row["n_children"]
                node.leaves += row["n_leaves"]
                node.saved += row["saved_tokens"]
                here[slot] = stack[depth]
                uses.append((at, slot, stack[depth]))
        finish(0)
        seen: set[int] = set()
        for a in range(0, len(uses), 10_000):
            out = []
            for shard, slot, i in uses[a : a + 10_000]:
                v = nodes[i]
                up = nodes[v.parent].least if v.parent >= 0 else None
                out.append((shard, slot, i, v.least, v.depth, up, v.n, v.children, v.leaves, v.saved, v.sha.hexdigest(), i not in seen))
                seen.add(i)
            names = [p.split()[0] for p in SPINE.split(", ")]
            kinds = [{"boolean": pa.bool_()}.get(k := p.split()[1]) or _TYPES[k] for p in SPINE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    # Member pieces come after the nodes of their shard, of which they need the places.
    order = ["shard", F.col("ends").isNotNull(), "slot", "piece"]
    return rows.repartition(1).sortWithinPartitions(*order).mapInArrow(merge, SPINE)


def trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per different prefix of ``paths(conv_id, path, sizes)``.

    ``path`` is the digests of a conversation's turns, ``sizes`` the bytes of their texts; ``conv_id``
    is a whole number, different in each row. A conversation's digests are held in one task, its texts
    are not. Equal conversations share all nodes. An empty table has no node.
    """
    shipped(paths.sparkSession)
    found = written(shards(paths, shard_turns), "trie_shards")
    spines = written(merged_spines(found.where("slot IS NOT NULL")), "trie_spines")
    figures = ["conv_id", "depth", "parent_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = found.where("slot IS NULL")
    alone = inner.where("parent_slot IS NULL").select(*figures)
    parents = spines.select(F.col("shard").alias("s"), F.col("slot").alias("p"), F.col("conv_id").alias("above"))
    hung = inner.where("parent_slot IS NOT NULL").join(
        parents, (F.col("shard") == F.col("s")) & (F.col("parent_slot") == F.col("p"))
    )
    hung = hung.select(*["above" if c == "parent_id" else c for c in figures]).toDF(*figures)
    out = alone.unionByName(hung).unionByName(spines.where("head").select(*figures))
    return out.withColumnRenamed("parent_id", "parent_conv_id")


def rebuilt(turns: DataFrame, conv: str, turn: str, role: str, text: str, group: int = 5, spread: int = 9) -> DataFrame:
    """(conv_id, path, sizes): conversations whose beginning is replaced by that of their group's first.

    With h = crc32(decimal c) % ``spread``, conversation c has the first h turns of conversation
    c - c % ``group``, if that exists, then its own turns after the first h. Turns are ordered by number,
    null first, then by digest. Null role or text is empty. Rows without a conversation belong to none.
    Repeated rows are turns of their own.
    """
    c = turns[conv].cast("long")
    rows = turns.where(c.isNotNull()).select(
        (c - c % group).alias("b"), c.alias("c"),
        F.struct(
            turns[turn].isNotNull().alias("o"), turns[turn].alias("t"), turn_digest(turns[role], turns[text]).alias("k"),
            F.octet_length(whole(turns[text])).cast("long").alias("n"),
        ).alias("x"),
    )
    # A conversation and the one it begins like are in one group of at most ``group``.
    each = rows.repartition("b").groupBy("b", "c").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    own = each.groupBy("b").agg(F.collect_list(F.struct("c", "xs")).alias("g"))
    first = F.get(F.filter("g", lambda s: s["c"] == F.col("b")), F.lit(0))["xs"]
    own = own.select(F.inline("g"), F.coalesce(first, F.array().cast(each.schema["xs"].dataType)).alias("base"))
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % spread).cast("int")
    turns_of = F.concat(F.slice("base", F.lit(1), h), F.slice("xs", h + 1, F.greatest(F.size("xs") - h, F.lit(0))))
    path = F.unhex(F.array_join(F.transform(turns_of, lambda x: F.hex(x["k"])), ""))
    return own.select(
        F.col("c").alias("conv_id"), path.alias("path"), F.transform(turns_of, lambda x: x["n"]).alias("sizes")
    )
