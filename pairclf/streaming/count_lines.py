"""Word totals over lines that keep arriving.

The running totals live in the state of the stream, spread over the cluster by
word; counts are added up before they are shuffled to it. Every batch writes the
totals that it has changed, as a table of its own, so that a repeated batch replaces
what it wrote before; a word's total is that of its last batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.lines import total_line
from ..session import new_table_path
from ..sources.count_lines import parse_count_lines


def stream_count_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(word, count)`` of the lines of every text file that appears in ``path``."""
    return parse_count_lines(spark.readStream.text(path))


def _totals_path(checkpoint: str) -> str:
    return checkpoint.rstrip("/") + "-totals"


def start_totals(counts: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Keep the total of every word up to date; ``once`` stops after what is there now."""
    totals = counts.groupBy("word").agg(F.sum("count").alias("total"))
    path = _totals_path(checkpoint)

    def write_batch(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = totals.writeStream.foreachBatch(write_batch).outputMode("update").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def current_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The totals after the last finished batch."""
    changed = spark.read.schema("word string, total bigint, batch bigint").parquet(_totals_path(checkpoint))
    last = changed.groupBy("word").agg(F.max_by("total", "batch").alias("total"))
    return last.select("word", "total", total_line(F.col("word"), F.col("total")).alias("line"))


def totals_of_available(counts: DataFrame) -> DataFrame:
    """Run the stream over what is there now and return the totals."""
    checkpoint = new_table_path(counts.sparkSession, "word-totals-stream")
    query = start_totals(counts, checkpoint, once=True)
    query.awaitTermination()
    return current_totals(counts.sparkSession, checkpoint)
