"""Feature rows packed into matrix blocks for the passes over all rows."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import BUCKETS
from .splits import with_bucket

BLOCK_SCHEMA = "label string, min_bucket int, buckets binary, vectors binary"
BLOCK_BYTES = 2 * 1024 * 1024
# Rows of labels whose blocks are not full yet, over all labels of a task.
HELD_BYTES = 64 * 1024 * 1024
# Least bytes of vectors in a partition of a pass, and how many times as many as the sums
# that every partition makes.
PART_BYTES = 128 * 1024 * 1024
BYTES_PER_SUM = 16


def vector_size(features: DataFrame) -> int:
    """Length of the vectors, from one row; packing checks it on all rows."""
    first = features.select(F.size("features").alias("size")).first()
    if first is None:
        raise ValueError("the feature table is empty")
    return first["size"]


def matrix_of_batch():
    """The function (Arrow column of vectors, size) -> matrix; uneven vectors raise.

    Made here so that it travels with the functions that run in the tasks.
    """

    def matrix(vectors, size):
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        if vectors.null_count or (lengths != size).any():
            raise ValueError(f"vectors of {size} numbers expected")
        values = vectors.flatten()
        if values.null_count:
            raise ValueError("a vector holds a null")
        return values.to_numpy().reshape(-1, size)

    return matrix


def in_larger_parts(features: DataFrame, vector_bytes: int, sum_bytes: int) -> DataFrame:
    """The rows in fewer partitions, where there are so many that the partial sums of all
    partitions would weigh much against the vectors. Nothing is shuffled, and enough
    partitions for all cores stay."""
    cores = features.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, math.ceil(vector_bytes / max(PART_BYTES, BYTES_PER_SUM * sum_bytes)))
    return features.coalesce(wanted) if features.rdd.getNumPartitions() > wanted else features


def pack_blocks(features: DataFrame, size: int, split_at: int = BUCKETS) -> DataFrame:
    """Blocks of one label each, its rows in bucket order.

    Every pass of the training reads blocks, so rows are packed once: a block is one
    binary matrix that passes to numpy without a copy. Packing follows the partitions
    of the scan, without a shuffle. A task holds back the rows of each label until
    they fill a block. No block has rows on both sides of ``split_at``, the largest
    cut, so a filter on ``min_bucket`` keeps test rows out of the training.
    """
    matrix_of = matrix_of_batch()
    row_limit = max(1, BLOCK_BYTES // (8 * size))
    held_limit = max(1, HELD_BYTES // (8 * size))

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        held = {}  # label -> pieces of (buckets, matrix)
        sizes = {}

        def blocks_of(label):
            buckets, matrix = (np.concatenate(parts) for parts in zip(*held.pop(label)))
            sizes.pop(label)
            order = np.argsort(buckets, kind="stable")
            buckets, matrix = buckets[order], matrix[order]
            border = int(np.searchsorted(buckets, split_at))
            for low, high in ((0, border), (border, len(buckets))):
                for start in range(low, high, row_limit):
                    stop = min(start + row_limit, high)
                    yield pa.RecordBatch.from_pydict({
                        "label": pa.array([label], pa.string()),
                        "min_bucket": pa.array([int(buckets[start])], pa.int32()),
                        "buckets": pa.array([buckets[start:stop].tobytes()], pa.binary()),
                        "vectors": pa.array([matrix[start:stop].tobytes()], pa.binary()),
                    })

        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = matrix_of(batch.column("features"), size)
            labels = batch.column("label").dictionary_encode()
            codes, buckets = labels.indices.to_numpy(), batch.column("bucket").to_numpy().astype("u1")
            for code, label in enumerate(labels.dictionary.to_pylist()):
                rows = np.flatnonzero(codes == code)
                held.setdefault(label, []).append((buckets[rows], matrix[rows]))
                sizes[label] = sizes.get(label, 0) + len(rows)
                if sizes[label] >= row_limit:
                    yield from blocks_of(label)
            while sum(sizes.values()) > held_limit:
                yield from blocks_of(max(sizes, key=sizes.get))
        for label in list(held):
            yield from blocks_of(label)

    if "bucket" not in features.columns:
        features = with_bucket(features)
    rows = features.select("label", "bucket", "features")
    return rows.mapInArrow(pack, BLOCK_SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
