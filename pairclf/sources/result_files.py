"""Writers of results: best models as JSON, report text, curves as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def best_model_json() -> Column:
    """The best-model record of a row as a JSON object."""
    return F.to_json(
        F.struct(F.col("accuracy").alias("Accuracy"), "numIter", "stepSize", "regParam"),
        {"ignoreNullFields": "false"},
    )


def write_best_models(best: DataFrame, path: str) -> None:
    """One JSON record per task and line; any number of tasks."""
    best.select("task", F.col("accuracy").alias("Accuracy"), "numIter", "stepSize", "regParam").write.json(path)


def write_best_models_object(best: DataFrame, path: str) -> None:
    """One JSON object keyed by task.

    Written as ordered text: the part files, joined in name order, are the
    object. No task holds more than its own range of the members.
    """
    last = best.agg(F.max("task")).first()[0]
    key = F.regexp_extract(F.to_json(F.struct("task")), r'^\{"task":(.*)\}$', 1)
    comma = F.when(F.col("task") == F.lit(last), "").otherwise(",")
    members = best.select(
        F.lit(1).alias("part"), F.col("task"), F.concat(key, F.lit(": "), best_model_json(), comma).alias("value")
    )
    spark = best.sparkSession
    frame = spark.createDataFrame([(0, "", "{"), (2, "", "}")], "part int, task string, value string")
    frame.unionByName(members).orderBy("part", "task").select("value").write.text(path)


def write_report(report: DataFrame, path: str) -> None:
    """The ``report`` column as text."""
    report.select(F.col("report").alias("value")).write.text(path)


def write_curve(curve: DataFrame, path: str, file_format: str = "parquet") -> None:
    """A series as a table, ``parquet`` or ``csv``."""
    writer = curve.write.format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.save(path)
