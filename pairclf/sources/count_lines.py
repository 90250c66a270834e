"""``word count`` lines: from text files or a column of lines, and totals as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.lines import count_line_fields


def parse_count_lines(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(word, count)`` of every line, with the columns in ``keep``."""
    return lines.select(*keep, count_line_fields(F.col(column)).alias("_fields")).select(
        *keep, "_fields.word", "_fields.count"
    )


def read_count_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_count_lines(spark.read.text(path))


def write_total_lines(totals: DataFrame, path: str) -> None:
    """Write the ``line`` column of word totals as text."""
    totals.select(F.col("line").alias("value")).write.text(path)
