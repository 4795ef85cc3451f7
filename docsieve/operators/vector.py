"""Exact nearest-neighbour search over an embedding column.

Scoring runs as Arrow batches against numpy: on this column type that measured about three
times faster than an interpreted lambda per element, and the gap grows with the dimension.
Every task keeps a running top-k, so only k rows per partition leave it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsieve.functions.scalars import metadata_map
from docsieve.operators.select import DEFAULT_ROWS

SIMILARITY_THRESHOLD = 0.7
# A hit list of up to this many rows of three numbers is sent to every task; it changes the plan, not the rows.
BROADCAST_ROWS = 10_000
# Query vectors sent to the tasks at once, and scores that a task holds at once (16 MB).
CHUNK_ROWS = 2_000
# Base rows that a task of a batch search holds.
BLOCK_ROWS = 50_000
SCORE_VALUES = 2_000_000


def stored_vector(df: DataFrame, key: str, value: object, vector: str = "embedding") -> list[float]:
    """The vector of one row, for use as a query."""
    row = df.where(F.col(key) == F.lit(value)).select(vector).first()
    if row is None:
        raise ValueError(f"no row with {key} = {value!r}")
    return [float(x) for x in row[0]]


def _units(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1))
    return rows / np.where(length > 0, length, 1.0)[:, None]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column without nulls as rows; a vector of another length is an error, never a score."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    wrong = lengths[lengths != dim]
    if len(wrong):
        raise ValueError(f"a vector has {wrong[0]} values where the query has {dim}")
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), dim)


def _scorer(query_ids: list, matrix: np.ndarray, k: int | None, threshold: float | None = None):
    """Task function: (key, vector) batches to (query_id, key, score) rows.

    With ``k`` the k best of every query in the task, else all that reach ``threshold``. Rows
    without a vector are dropped here: as a Spark filter the test would be pushed below a computed
    vector column and compute it twice. Scores are made for so many rows at a time that their
    matrix stays within SCORE_VALUES.
    """
    matrix = np.asarray(matrix, dtype="float64")
    units, dim = _units(matrix), matrix.shape[1]
    ids = np.asarray(query_ids, dtype=np.int64)
    step = max(1, SCORE_VALUES // len(ids))

    def best_of(found: pa.Table) -> pa.Table:
        ordered = found.sort_by([("query", "ascending"), ("score", "descending"), ("key", "ascending")])
        query = ordered.column("query").to_numpy()
        first = np.searchsorted(query, query)
        return ordered.filter(pa.array(np.arange(len(query)) - first < k))

    def out(found: pa.Table) -> Iterator[pa.RecordBatch]:
        query = pa.array(ids[found.column("query").to_numpy()])
        table = pa.table({"query_id": query, "key": found.column("key"), "score": found.column("score")})
        yield from table.combine_chunks().to_batches()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            batch = batch.filter(batch.column(1).is_valid())
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                scores = _units(_matrix(part.column(1), dim)) @ units.T
                if k is None:
                    row, query = np.nonzero(scores >= threshold)
                elif len(part) > k:
                    # What ties with the k-th best stays for the tie-break by key.
                    limit = np.partition(scores, len(part) - k, axis=0)[len(part) - k]
                    row, query = np.nonzero(scores >= limit)
                else:
                    row, query = np.nonzero(np.ones_like(scores, dtype=bool))
                found = pa.table({
                    "query": pa.array(query), "key": part.column(0).take(pa.array(row)),
                    "score": pa.array(scores[row, query]),
                })
                if k is None:
                    yield from out(found)
                else:
                    kept = best_of(found if kept is None else pa.concat_tables([kept, found]))
        if kept is not None:
            yield from out(kept)

    return score


def _scored(
    df: DataFrame, key: str, vector: str, query_ids: list, matrix: np.ndarray, k: int | None,
    threshold: float | None = None,
) -> DataFrame:
    key_sql = df.schema[key].dataType.simpleString()
    task = _scorer(query_ids, matrix, k, threshold)
    return df.select(key, vector).mapInArrow(task, f"query_id bigint, key {key_sql}, score double")


def knn(
    df: DataFrame,
    query: Sequence[float],
    key: str,
    k: int = DEFAULT_ROWS,
    vector: str = "embedding",
    where: Column | None = None,
) -> DataFrame:
    """(key, score, distance) of the k nearest rows: cosine score, distance = 1 - score.

    ``where`` is applied first and reaches the scan (pre-filter).
    """
    rows = df if where is None else df.where(where)
    scored = _scored(rows, key, vector, [0], np.array([query]), k)
    return (
        scored.select(F.col("key").alias(key), "score", (1 - F.col("score")).alias("distance"))
        .orderBy(F.desc("score"), key)
        .limit(k)
    )


def within(
    df: DataFrame,
    query: Sequence[float],
    key: str,
    threshold: float = SIMILARITY_THRESHOLD,
    vector: str = "embedding",
) -> DataFrame:
    """Every row whose cosine score reaches the threshold."""
    scored = _scored(df, key, vector, [0], np.array([query]), None, threshold)
    return scored.select(
        F.col("key").alias(key), "score", (1 - F.col("score")).alias("distance")
    )


def attach(df: DataFrame, hits: DataFrame, key: str, k: int) -> DataFrame:
    """Join a top-k hit list back to its rows. A short list is broadcast, a long one is not."""
    side = F.broadcast(hits) if k <= BROADCAST_ROWS else hits
    return df.join(side, key)


def keep_neighbours(df: DataFrame, hits: DataFrame, key: str, k: int) -> DataFrame:
    """Rows whose key is among the neighbours, without the score."""
    side = F.broadcast(hits) if k <= BROADCAST_ROWS else hits
    return df.join(side, key, "left_semi")


def vector_select(
    df: DataFrame,
    query: Sequence[float],
    key: str,
    fields: Sequence[str],
    where: Column | None = None,
    limit: int = DEFAULT_ROWS,
    offset: int = 0,
    vector: str = "embedding",
) -> DataFrame:
    """Fields of the filtered neighbours, nearest first; k is limit + offset."""
    k = limit + offset
    hits = knn(df, query, key, k, vector, where)
    page = hits.orderBy(F.desc("score"), key).offset(offset).limit(limit)
    names = [f for f in fields if f not in (key, "score", "distance")]
    rows = attach(df.select(key, *names), page, key, k)
    return rows.select(key, *names, "score", "distance").orderBy(F.desc("score"), key)


def post_filter(df: DataFrame, hits: DataFrame, key: str, where: Column, k: int) -> DataFrame:
    """Filter after the neighbours are fixed, so fewer than k rows can remain."""
    return attach(df, hits, key, k).where(where)


def hit_frame(df: DataFrame, hits: DataFrame, key: str, reserved: Sequence[str], k: int) -> DataFrame:
    """(id, score, distance, metadata, num_found, k) rows of a hit list."""
    # The list holds at most k rows, so counting them in one window is bounded.
    counted = hits.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))
    rows = attach(df, counted, key, k)
    meta = metadata_map(rows, [key, "score", "distance", "_n", *reserved])
    return rows.select(
        F.col(key).cast("string").alias("id"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "distance",
        meta.alias("metadata"),
        F.col("_n").alias("num_found"),
        F.lit(k).alias("k"),
    )


def knn_batch(
    df: DataFrame,
    queries: DataFrame,
    key: str,
    k: int = DEFAULT_ROWS,
    vector: str = "embedding",
    query_key: str = "query_id",
    query_vector: str = "query_vector",
    chunk_rows: int = CHUNK_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, key, score, rank) of the k nearest rows for every query vector.

    The base is dealt by hash into blocks of about ``block_rows``; every block meets all queries, which
    are sent to it and stream past it, ``chunk_rows`` at a time. So a task holds one block and some scores,
    neither side passes through the driver, and the plan does not grow with the queries. Each query
    leaves a block with its k best rows. Queries without a vector have no neighbours; rows that are equal in
    key and vector share a block.
    """
    wanted = queries.where(F.col(query_vector).isNotNull()).select(
        F.col(query_key).cast("bigint").alias("query_id"),
        F.col(query_vector).cast("array<double>").alias("vector"),
    )
    size = wanted.agg(F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most")).first().asDict()
    if size["least"] != size["most"]:
        raise ValueError(f"query vectors have {size['least']} and {size['most']} values")
    blocks = max(1, -(-df.count() // block_rows))
    base = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    base = base.select(
        F.pmod(F.xxhash64("key", "vector"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asks"),
        F.lit(None).cast("bigint").alias("query_id"), "key", "vector",
    )
    asking = wanted.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), "query_id",
        F.lit(None).cast(df.schema[key].dataType).alias("key"), "vector",
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            batch = batch.filter(batch.column("vector").is_valid())
            block = batch.column("block").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            # Runs of one block's rows, then of the queries that meet it.
            turn = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (asks[1:] != asks[:-1]))) if len(block) else []
            for a, b in zip(turn, [*turn[1:], len(block)]):
                if block[a] != at:
                    at, held = block[a], []
                part = batch.slice(a, b - a)
                if not asks[a]:
                    held.append(pa.table({"key": part.column("key"), "vector": part.column("vector")}))
                    continue
                if not held:
                    continue
                if len(held) > 1:
                    held = [pa.concat_tables(held)]
                rows = held[0].combine_chunks().to_batches()
                for c in range(0, len(part), chunk_rows):
                    some = part.slice(c, chunk_rows)
                    matrix = _matrix(some.column("vector"), size["most"])
                    yield from _scorer(some.column("query_id").to_pylist(), matrix, k)(iter(rows))

    key_sql = df.schema[key].dataType.simpleString()
    met = base.unionByName(asking).repartition("block").sortWithinPartitions("block", "asks")
    found = met.mapInArrow(meet, f"query_id bigint, key {key_sql}, score double")
    return best_per_query(found, k).withColumnRenamed("key", key)


def best_per_query(partial: DataFrame, k: int) -> DataFrame:
    """Rank the partial lists. Spark keeps k rows per query and task before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
