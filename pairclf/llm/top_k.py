"""Exact top-k search by inner products of integer vectors.

Queries and candidates are packed into tiles. Every query tile meets every candidate
tile; a task multiplies two tiles as matrices, keeps the best of each query in the
tile, and top lists are merged in a tree until one list for each query is left.

Components are floor(scale * x). Vectors that are null or empty, or hold null or
non-finite components, take no part; vectors of unequal lengths raise an error. A
candidate with the query's own id is not counted. Repeated rows are repeated candidates,
each with a place of its own; repeated rows of a query are one query, while an id with
different vectors has a list for each of them. Ties go to the smaller id. With fewer than
k candidates all are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import write_table
from .common import map_batches

QUERY_TILE = 2_048
CANDIDATE_TILE = 8_192
#: Candidate tiles for which one copy of a query tile is sent.
TILES_PER_CELL = 4
#: Cells of a product that are held at once.
CELLS = 4_000_000
#: Lists that one step of the tree merges.
FAN_IN = 16
#: Sums of products below this are exact in double precision.
EXACT = float(1 << 53)


def integer_vectors(df: DataFrame, identity: str, vector: str, scale: int) -> DataFrame:
    """id, values: the rows that take part, as whole numbers."""
    values = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    # Under a null vector, or one with a null, this is null and drops the row.
    usable = F.forall(
        F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return df.filter(F.col(identity).isNotNull() & usable & (F.size(vector) > 0)).select(
        F.col(identity).cast("bigint").alias("id"), values.alias("values")
    )


def _pack(size: int):
    """Work that packs the rows of a partition into tiles of up to ``size`` rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while batch.num_rows:
                piece = batch.slice(0, size - rows)
                batch = batch.slice(piece.num_rows)
                held.append(piece)
                rows += piece.num_rows
                if rows == size:
                    yield _tile(held)
                    held, rows = [], 0
        if held:
            yield _tile(held)

    return work


def _tile(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    whole = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
    values = whole.column("values")
    lengths = np.unique(np.asarray(values.value_lengths()))
    if len(lengths) != 1:
        raise ValueError(f"vectors have unequal lengths: {lengths.tolist()[:5]}")
    numbers = np.asarray(values.flatten(), dtype=np.int64)
    ids = np.asarray(whole.column("id"), dtype=np.int64)
    order = np.argsort(ids, kind="stable")
    numbers = numbers.reshape(len(ids), -1)[order]
    return pa.RecordBatch.from_arrays(
        [pa.array([len(ids)], pa.int32()), pa.array([ids[order].tobytes()], pa.binary()), pa.array([numbers.tobytes()], pa.binary())],
        names=["size", "ids", "numbers"],
    )


TILE = "size int, ids binary, numbers binary"


def _best(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _best_of_tiles(row, k)

    return work


def _matrix(row: dict, side: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{side}_ids"], dtype=np.int64)
    return ids, np.frombuffer(row[f"{side}_numbers"], dtype=np.int64).reshape(len(ids), -1)


def _best_of_tiles(row: dict, k: int) -> pa.RecordBatch:
    query_ids, queries = _matrix(row, "query")
    ids, numbers = _matrix(row, "candidate")
    if queries.shape[1] != numbers.shape[1]:
        raise ValueError(f"vectors have unequal lengths: {queries.shape[1]} and {numbers.shape[1]}")
    largest = float(np.abs(queries.astype(np.float64)).max()) * float(np.abs(numbers.astype(np.float64)).max()) * queries.shape[1]
    kind = np.float64 if largest < EXACT else np.int64
    columns = np.ascontiguousarray(numbers.T.astype(kind))
    found_query, found_row, found_id, found_score = [], [], [], []
    step = max(1, CELLS // len(ids))
    for start in range(0, len(query_ids), step):
        scores = queries[start : start + step].astype(kind) @ columns
        # One place more than k, as the query itself may be among the best.
        reach = min(len(ids), k + 1)
        border = np.partition(scores, len(ids) - reach, axis=1)[:, len(ids) - reach]
        for i, query in enumerate(query_ids[start : start + step]):
            at = np.flatnonzero(scores[i] >= border[i])
            at = at[ids[at] != query]
            if len(at) < min(k, len(ids)):  # repeated rows of the query's own id
                at = np.flatnonzero(ids != query)
            # Ids ascend within a tile, so a stable order gives ties to the smaller.
            at = at[np.argsort(-scores[i][at], kind="stable")[:k]]
            found_query.append(np.full(len(at), query))
            found_row.append(np.full(len(at), start + i))
            found_id.append(ids[at])
            found_score.append(scores[i][at].astype(np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x).astype(np.int64)) for x in (found_query, found_row, found_id, found_score)]
        + [pa.array(np.full(sum(map(len, found_id)), row[side], dtype=np.int64)) for side in ("query_number", "candidate_tile")],
        names=["query_id", "place", "vec_id", "score", "tile", "list"],
    )


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, identity: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the best k candidates of each query.

    Queries are the rows for which ``is_query`` holds, candidates all rows. Both are
    written as tiles; a candidate tile is sent once for each query tile.
    """
    usable = integer_vectors(vectors, identity, vector, scale)
    queries = integer_vectors(vectors.filter(is_query), identity, vector, scale).distinct()
    # Few queries lie in many partitions: they are dealt anew to fill their tiles.
    query_tiles_count = max(1, math.ceil(queries.select("id").count() / QUERY_TILE))
    dealt = queries.repartitionById(query_tiles_count, F.pmod(F.xxhash64("id"), F.lit(query_tiles_count)).cast("int"))
    query_tiles = map_batches(dealt, _pack(QUERY_TILE), TILE).withColumn("query_tile", F.spark_partition_id())
    query_tiles = write_table(query_tiles.withColumn("query_number", F.monotonically_increasing_id()), "query-tiles")
    tiles = map_batches(usable, _pack(CANDIDATE_TILE), TILE).withColumn("candidate_tile", F.monotonically_increasing_id())
    tiles = write_table(tiles, "candidate-tiles")
    count = tiles.count()
    # Cells of a query tile and a salt, which spreads the candidate tiles.
    salts = max(1, math.ceil(count / TILES_PER_CELL))
    spread = F.pmod(F.xxhash64("candidate_tile"), F.lit(salts))
    right = _named(tiles, "candidate").withColumn("salt", spread)
    right = right.withColumn("query_tile", F.explode(F.sequence(F.lit(0), F.lit(query_tiles_count - 1))))
    left = _named(query_tiles, "query", "query_number").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    lists = map_batches(
        right.join(left, ["query_tile", "salt"]), _best(k), "query_id bigint, place bigint, vec_id bigint, score bigint, tile bigint, list bigint"
    )
    # The tree: lists of FAN_IN tiles are merged until all tiles of a query are.
    # A query row is told by its tile and its place in it, not by its id alone.
    numbered = lists.withColumn("list", F.xxhash64("list"))
    while True:
        last = count <= FAN_IN
        count = 1 if last else math.ceil(count / FAN_IN)
        numbered = numbered.withColumn("list", F.lit(0) if last else F.pmod("list", F.lit(count)))
        best = Window.partitionBy("tile", "place", "list").orderBy(F.col("score").desc(), "vec_id")
        numbered = numbered.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        if last:
            return numbered.select("query_id", "rank", "vec_id", "score")
        numbered = numbered.drop("rank")


def _named(tiles: DataFrame, side: str, *more: str) -> DataFrame:
    return tiles.select(f"{side}_tile", *more, F.col("ids").alias(f"{side}_ids"), F.col("numbers").alias(f"{side}_numbers"))
