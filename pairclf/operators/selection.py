"""Best models and learning curves from the metrics of a grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.names import curve_name, task_key
from ..functions.reports import best_model_report, model_report
from .classes import TASK


def best_models(metrics: DataFrame) -> DataFrame:
    """Highest test accuracy per task and training share; ties go to the first model.

    A task whose models all score 0, or that has no test row, keeps its row with
    null parameters. A window holds the grid points of one task.
    """
    by_accuracy = Window.partitionBy(*TASK).orderBy(F.col("accuracy").desc_nulls_last(), "model_number")
    best = (
        metrics.filter(F.col("eval_set") == "test")
        .withColumn("_rank", F.row_number().over(by_accuracy))
        .filter(F.col("_rank") == 1)
    )
    found = F.col("accuracy") > 0
    parameters = [F.when(found, F.col(c)).alias(c) for c in ("model_number", "numIter", "stepSize", "regParam")]
    return best.select(
        *TASK, task_key(F.col("class1"), F.col("class2")).alias("task"), *parameters,
        "hits", "errors", "total", "accuracy", "error_rate",
    )


def last_fraction(best: DataFrame) -> DataFrame:
    """The record that survives per task when a later share overwrites an earlier one."""
    by_fraction = Window.partitionBy("kind", "class1", "class2").orderBy(F.col("train_fraction").desc())
    return best.withColumn("_rank", F.row_number().over(by_fraction)).filter(F.col("_rank") == 1).drop("_rank")


def iteration_curve(metrics: DataFrame) -> DataFrame:
    """Accuracy against iterations, one series per task and evaluation set."""
    return metrics.select(
        *TASK, curve_name(F.col("train_fraction"), F.col("class1"), F.col("class2")).alias("curve"),
        "eval_set", "numIter", "stepSize", "regParam", "accuracy",
    )


def fraction_curve(best: DataFrame) -> DataFrame:
    """Best accuracy against the training share, one series per task."""
    return best.select("kind", "class1", "class2", "task", "train_fraction", "accuracy")


def model_reports(metrics: DataFrame) -> DataFrame:
    return metrics.select(*TASK, "model_number", "eval_set", model_report(F.col("eval_set")).alias("report"))


def best_model_reports(best: DataFrame) -> DataFrame:
    return best.select(*TASK, "task", best_model_report().alias("report"))
