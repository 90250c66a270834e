"""Report text of a model and of a best model."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed_values import BEST_REPORT_FORMAT, MODEL_REPORT_FORMAT


def fixed_point(value: Column, digits: int) -> Column:
    """``%.Nf`` with ties broken on the exact binary value, to the even digit.

    ``format_number`` rounds that way while ``format_string`` rounds half up; it
    also groups thousands, which a report does not. It is wrong for half of the
    last digit alone, which is thus written out.
    """
    half = 5 / 10 ** (digits + 1)
    number = value.cast("double")
    return F.when(number == half, F.lit(f"{half:.{digits}f}")).otherwise(
        F.regexp_replace(F.format_number(number, digits), ",", "")
    )


def model_report(eval_set: Column) -> Column:
    """Three lines for one grid point; reads the metric columns by name."""
    title = F.when(eval_set == "all", F.lit("Model_All")).otherwise(F.lit("Model"))
    return F.format_string(
        MODEL_REPORT_FORMAT,
        title, F.col("model_number"),
        title, *_parameters(),
        title, *_quality(),
    )


def best_model_report() -> Column:
    """Three lines for the best model of a task; reads the metric columns by name."""
    return F.format_string(BEST_REPORT_FORMAT, F.col("model_number"), *_parameters(), *_quality())


def _parameters() -> list[Column]:
    return [fixed_point(F.col(name), 2) for name in ("numIter", "stepSize", "regParam")]


def _quality() -> list[Column]:
    return [fixed_point(F.col("accuracy"), 3), F.col("errors"), fixed_point(F.col("error_rate"), 3)]
