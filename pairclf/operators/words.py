"""Word totals: per word, and per run of equal consecutive words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.lines import total_line
from ..session import write_table


def word_totals(counts: DataFrame) -> DataFrame:
    """Total per word; counts are added up before the shuffle."""
    totals = counts.groupBy("word").agg(F.sum("count").alias("total"))
    return totals.select("word", "total", total_line(F.col("word"), F.col("total")).alias("line"))


def word_run_totals(counts: DataFrame, position: str) -> DataFrame:
    """Total per run of equal words in the order of ``position``, ties in order of the word.

    Rows are shuffled once, into sorted ranges of positions. One pass over each range adds
    up its runs. Runs inside a range are final; only the first and the last run of a range
    may go on beyond it, so only those meet again, at most two rows per range. A run as
    long as the whole input is still summed in parts. A null count counts as 0.
    """
    order = [position, "word"]
    ranged = counts.repartitionByRange(*order).sortWithinPartitions(*order).select("word", "count")
    schema = "part int, run bigint, word string, total bigint, border boolean"
    # Written once, so that all uses see the same ranges.
    runs = write_table(ranged.mapInArrow(_add_runs(), schema), "runs")
    ends = runs.filter("border").groupBy("part").agg(
        F.min_by("word", "run").alias("_first"), F.max_by("word", "run").alias("_last"), F.max("run").alias("_runs")
    )
    # One row per range in this window.
    over_ranges = Window.orderBy("part")
    joins = F.coalesce(F.lag("_last").over(over_ranges).eqNullSafe(F.col("_first")).cast("bigint"), F.lit(0))
    joins = F.when(F.row_number().over(over_ranges) == 1, F.lit(0)).otherwise(joins)
    offsets = (
        ends.withColumn("_new", F.col("_runs") - joins)
        .withColumn("_end", F.sum("_new").over(over_ranges))
        .select("part", (F.col("_end") - F.col("_runs")).alias("_offset"))
    )
    numbered = runs.join(F.broadcast(offsets), "part").withColumn("run", F.col("_offset") + F.col("run"))
    inner = numbered.filter(~F.col("border")).select("run", "word", "total")
    joined = numbered.filter("border").groupBy("run", "word").agg(F.sum("total").alias("total"))
    return inner.unionByName(joined).select("run", "word", "total", total_line(F.col("word"), F.col("total")).alias("line"))


def _add_runs():
    """The pass over one sorted range: its runs, numbered from 1, the first and the last
    one marked as ``border``."""

    def add_runs(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def made(first_number, words, totals, last=False):
            numbers = np.arange(first_number, first_number + len(words))
            border = numbers == 1
            if last and len(border):
                border[-1] = True
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(words), part), pa.int32()), pa.array(numbers, pa.int64()),
                    words.cast(pa.string()), pa.array(totals, pa.int64()), pa.array(border, pa.bool_()),
                ],
                names=["part", "run", "word", "total", "border"],
            )

        # The run that is still open: its word, as an array of one, and its total.
        open_word, open_total, number = None, 0, 1
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("word")
            if open_word is None:
                open_word = words.slice(0, 1)
            around = pa.concat_arrays([open_word, words])
            old, new = around.slice(0, len(words)), words
            different = pc.or_(pc.fill_null(pc.not_equal(old, new), False), pc.xor(old.is_null(), new.is_null()))
            starts = np.flatnonzero(different.to_numpy(zero_copy_only=False))
            sums = np.concatenate([[0], np.cumsum(pc.fill_null(batch.column("count"), 0).to_numpy(zero_copy_only=False))])
            if not len(starts):
                open_total += int(sums[-1])
                continue
            # The open run ends at the first start; each start but the last one begins and
            # ends a run of this batch.
            edges = sums[starts]
            totals = np.concatenate([[open_total + int(edges[0])], np.diff(edges)])
            ended = pa.concat_arrays([open_word, words.take(pa.array(starts[:-1]))])
            yield made(number, ended, totals)
            number += len(ended)
            open_word, open_total = words.slice(int(starts[-1]), 1), int(sums[-1] - edges[-1])
        if open_word is not None:
            yield made(number, open_word, [open_total], last=True)

    return add_runs
