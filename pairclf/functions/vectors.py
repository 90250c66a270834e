"""Vectors as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def last_line(text: Column) -> Column:
    """The last line that is not blank; null when there is none."""
    lines = F.filter(F.split(text, "\r\n|\r|\n"), lambda line: F.trim(line) != "")
    return F.try_element_at(lines, F.lit(-1))


# Fixed value: decimal numbers with or without exponent, infinities and nan; the cast
# alone would also take type suffixes and hexadecimal numbers.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def _number(text: Column) -> Column:
    value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(
        value.isNull(), F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double")
    ).otherwise(value)


def parse_vector(line: Column) -> Column:
    """``[f, f, ...]`` or ``f,f,...`` to ``ARRAY<DOUBLE>``; a bad number raises."""
    body = F.regexp_replace(F.trim(line), r"^[\[\]]+|[\[\]]+$", "")
    return F.transform(F.split(body, ","), _number)


def vector_text(features: Column) -> Column:
    """Inverse of :func:`parse_vector`."""
    numbers = F.transform(features, lambda value: value.cast("string"))
    return F.concat(F.lit("["), F.array_join(numbers, ", "), F.lit("]"))
