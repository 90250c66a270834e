"""Names: label of a file name, task keys, curve names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed_values import CURVE_NAME_FORMAT, NAME_SUFFIX_LENGTH, TASK_KEY_FORMAT


def label_from_file_name(file_name: Column) -> Column:
    """Class name held in a file name: no digits, no suffix, no outer underscores."""
    letters = F.regexp_replace(file_name, "[0-9]", "")
    stem = F.left(letters, F.greatest(F.length(letters) - NAME_SUFFIX_LENGTH, F.lit(0)))
    return F.btrim(stem, F.lit("_"))


def task_key(class1: Column, class2: Column) -> Column:
    return F.format_string(TASK_KEY_FORMAT, class1, class2)


def curve_name(train_fraction: Column, class1: Column, class2: Column) -> Column:
    return F.format_string(CURVE_NAME_FORMAT, train_fraction.cast("string"), class1, class2)
