"""``word count`` lines and the text of totals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed_values import WORD_TOTAL_FORMAT


def count_line_fields(line: Column) -> Column:
    """Struct ``(word, count)`` of a line of exactly two fields; other lines raise."""
    fields = F.split(F.regexp_replace(line, r"^\s+|\s+$", ""), r"\s+")
    bad = F.raise_error(F.concat(F.lit("not a 'word count' line: "), line))
    word = F.get(fields, 0)
    count = F.when(F.get(fields, 1).rlike(r"^[+-]?[0-9]+$"), F.get(fields, 1).try_cast("bigint"))
    valid = (F.size(fields) == 2) & count.isNotNull()
    return F.struct(
        F.when(valid, word).otherwise(bad.cast("string")).alias("word"),
        F.when(valid, count).otherwise(bad.cast("bigint")).alias("count"),
    )


def total_line(word: Column, total: Column) -> Column:
    return F.format_string(WORD_TOTAL_FORMAT, word, total)
