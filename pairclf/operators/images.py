"""Index of image names on the test side of a task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .indexing import string_index
from .splits import with_bucket


def pair_test_rows(features: DataFrame, tasks: DataFrame) -> DataFrame:
    """Test rows of every pair task: one equi-join on the label."""
    sides = tasks.filter(F.col("kind") == "1vs1").withColumn("label", F.explode(F.array("class1", "class2")))
    rows = with_bucket(features.select("label", "images"))
    return sides.join(rows, "label").filter(F.col("bucket") >= F.col("cut"))


def pair_image_index(features: DataFrame, tasks: DataFrame) -> DataFrame:
    """Index of the test images per pair task."""
    keys = ["class1", "class2", "train_fraction"]
    return string_index(pair_test_rows(features, tasks), "images", "images_index", keys)


def rest_image_index(features: DataFrame, percents: list[int]) -> DataFrame:
    """Index of the test images per training share: all rest tasks of one share
    test the same rows, so they have one index in common."""
    cuts = F.explode(F.array(*[F.lit(int(p)) for p in percents]))
    rows = (
        with_bucket(features.select("images")).withColumn("cut", cuts)
        .filter(F.col("bucket") >= F.col("cut"))
        .withColumn("train_fraction", F.col("cut") / 100)
    )
    return string_index(rows, "images", "images_index", ["train_fraction"])
