"""Numbers in order, and string indices, over columns of any number of distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from ..session import write_table


def number_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Number the rows of each key from 0 in the given total order.

    A window would put all rows of one key into one task. Here the rows are range sorted
    over all tasks, and one pass over each partition numbers the rows of every key in it
    from 0. Only the first key of a partition may have begun before; its rows so far are
    those of the partitions before that end with it, told by one or two marked rows of
    each partition. Rows are shuffled once, for the sort, and written once.
    """
    in_order = df.orderBy(*[F.col(k) for k in keys], *order)
    if keys:
        marks = [
            StructField("_part", IntegerType()), StructField("_place", LongType()),
            StructField("_first", BooleanType()), StructField("_border", BooleanType()),
        ]
        placed = in_order.mapInArrow(_number_segments(list(keys)), StructType([*df.schema.fields, *marks]))
        placed = write_table(placed, "ordered")
        # At most two rows per sort partition, found by a filter on the mark.
        borders = placed.filter("_border").select("_part", *keys, "_first", (F.col("_place") + 1).alias("_rows"))
    else:
        # One key in all: a row's place in its partition needs no look at the rows.
        place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        placed = write_table(in_order.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")), "ordered")
        placed = placed.withColumn("_first", F.lit(True))
        borders = placed.groupBy("_part").agg(F.max(F.col("_place") + 1).alias("_rows"), F.first("_first").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    started = borders.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).filter("_first")
    numbered = placed.join(F.broadcast(started.select("_part", "_before")), "_part")
    number = F.col("_place") + F.when(F.col("_first"), F.col("_before")).otherwise(F.lit(0))
    return numbered.select(*df.columns, number.alias("number"))


def _number_segments(keys: list[str]):
    """The pass over one sorted partition: ``_place`` numbers the rows of a key, ``_first``
    tells the rows of the partition's first key, and ``_border`` the last row of the first
    key and of the partition."""

    def changes(values):
        """Where a value differs from the one before it."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        old, new = values.slice(0, len(values) - 1), values.slice(1)
        different = pc.fill_null(pc.not_equal(old, new), False)
        if pa.types.is_floating(values.type):
            nan = pc.and_(pc.is_nan(old), pc.is_nan(new))
            different = pc.and_not(different, pc.fill_null(nan, False))
        return np.asarray(pc.or_(different, pc.xor(old.is_null(), new.is_null())).to_numpy(zero_copy_only=False), dtype=bool)

    def number(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def marked(rows, places, first, border):
            return pa.RecordBatch.from_arrays(
                [
                    *rows.columns, pa.array(np.full(rows.num_rows, part), pa.int32()), pa.array(places, pa.int64()),
                    pa.array(first, pa.bool_()), pa.array(border, pa.bool_()),
                ],
                names=[*rows.schema.names, "_part", "_place", "_first", "_border"],
            )

        # The last row so far is held back until it is known whether its key goes on.
        held = None  # (row, place, whether of the first key)
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            starts = np.zeros(size, dtype=bool)
            for name in keys:
                values = batch.column(name)
                before = values.slice(0, 1) if held is None else held[0].column(name)
                starts |= changes(pa.concat_arrays([before, values]))
            rows = np.arange(size)
            open_rows, in_first = (0, True) if held is None else (held[1] + 1, held[2])
            start = np.maximum.accumulate(np.where(starts, rows, -1))
            places = np.where(start >= 0, rows - start, rows + open_rows)
            first = (start < 0) & in_first
            border = np.zeros(size, dtype=bool)
            border[:-1] = first[:-1] & ~first[1:]
            if held is not None:
                yield marked(held[0], [held[1]], [held[2]], [held[2] and not first[0]])
            if size > 1:
                yield marked(batch.slice(0, size - 1), places[:-1], first[:-1], border[:-1])
            held = batch.slice(size - 1), int(places[-1]), bool(first[-1])
        if held is not None:
            yield marked(held[0], [held[1]], [held[2]], [True])

    return number


def string_index(df: DataFrame, column: str, output: str, keys: Sequence[str] = ()) -> DataFrame:
    """Index table of a string column, per key: most frequent first, ties by value."""
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    numbered = number_in_order(counts, keys, [F.col("_n").desc(), F.col(column)])
    return numbered.select(*keys, column, F.col("number").cast("double").alias(output))


def apply_index(df: DataFrame, index: DataFrame, column: str, output: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add the index to rows; a value the index does not know raises."""
    joined = df.join(index, [*keys, column], "left")
    unseen = F.raise_error(F.concat(F.lit("unseen value: "), F.coalesce(F.col(column), F.lit("null"))))
    return joined.withColumn(
        output, F.when(F.col(output).isNull(), unseen.cast("double")).otherwise(F.col(output))
    )
