"""Split sizes and label indices of all tasks from one small count table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.buckets import split_bucket
from ..functions.fixed_values import BUCKETS, REST_LABEL
from .classes import TASK


def with_bucket(features: DataFrame, seed: str = "") -> DataFrame:
    return features.withColumn("bucket", split_bucket(F.col("images"), seed))


def random_split(features: DataFrame, train_percent: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Spark's own seeded split; it hangs on row order, unlike the bucket split."""
    train, test = features.randomSplit([train_percent / 100, 1 - train_percent / 100], seed)
    return train, test


def bucket_counts(bucketed: DataFrame) -> DataFrame:
    """Rows per (label, bucket): at most classes x 100 rows, whatever the input.

    All split sizes and label frequencies of all tasks are sums of these, so
    rows are never copied per task to count them.
    """
    return bucketed.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n"))


def bucket_sums(counts: DataFrame) -> DataFrame:
    """Per label, and for all labels as ``is_total``, the rows below every bucket:
    ``below[cut]`` is the train size of a cut, and the last entry the number of rows.
    At most 100 buckets go into one array."""
    none, total = F.lit(None).cast("string"), F.lit(True)
    keys = F.explode(F.array(
        F.struct(F.col("label"), F.lit(False).alias("is_total")), F.struct(none.alias("label"), total.alias("is_total"))
    ))
    by_bucket = counts.select(keys.alias("_key"), "bucket", "n").groupBy("_key", "bucket").agg(F.sum("n").alias("n"))
    filled = by_bucket.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("_sizes"))
    sums = F.aggregate(
        F.sequence(F.lit(0), F.lit(BUCKETS - 1)),
        F.array(F.lit(0).cast("bigint")),
        lambda below, bucket: F.concat(
            below, F.array(F.element_at(below, -1) + F.coalesce(F.element_at("_sizes", bucket), F.lit(0).cast("bigint")))
        ),
    )
    return filled.select("_key.label", "_key.is_total", sums.alias("below"))


def task_label_counts(counts: DataFrame, tasks: DataFrame) -> DataFrame:
    """Train and test rows per task and task label.

    A cut is one look into the sums of a label. The label of a rest task is ``class1`` or
    ``All``; ``All`` counts as the total less ``class1``, which needs no row of the other
    classes.
    """
    sums = bucket_sums(counts)
    is_rest = F.col("kind") == "1vsAll"
    sides = tasks.withColumn("_side", F.explode(F.array(
        F.struct(F.col("class1").alias("task_label"), F.lit(False).alias("is_total")),
        F.struct(F.when(is_rest, F.lit(REST_LABEL)).otherwise(F.col("class2")).alias("task_label"), is_rest.alias("is_total")),
    ))).select(*tasks.columns, "_side.*")
    own = sums.select(F.when(~F.col("is_total"), F.col("label")).alias("_label"), F.col("is_total"), "below")
    named = sides.withColumn("_label", F.when(~F.col("is_total"), F.col("task_label")))
    counted = named.join(own, named["_label"].eqNullSafe(own["_label"]) & (named["is_total"] == own["is_total"])).select(
        *[named[c] for c in [*tasks.columns, "task_label", "is_total"]], "below"
    )
    # What a total leaves out: the sums of its class.
    less = sums.filter(~F.col("is_total")).select(F.col("label").alias("_less"), F.col("below").alias("_less_below"))
    counted = counted.withColumn("_less", F.when(F.col("is_total"), F.col("class1"))).join(less, "_less", "left")

    def size(place: Column) -> Column:
        return F.element_at("below", place) - F.coalesce(F.element_at("_less_below", place), F.lit(0))

    train = size(F.col("cut") + 1)
    return counted.select(
        *tasks.columns, "task_label", train.alias("n_train"), (size(F.lit(-1)) - train).alias("n_test")
    )


def split_counts(label_counts: DataFrame) -> DataFrame:
    """Rows on the train and the test side of every task."""
    sums = label_counts.groupBy(*TASK).agg(F.sum("n_train").alias("n_train"), F.sum("n_test").alias("n_test"))
    side = F.explode(F.array(
        F.struct(F.lit(False).alias("is_test"), F.col("n_train").alias("n")),
        F.struct(F.lit(True).alias("is_test"), F.col("n_test").alias("n")),
    ))
    return sums.select(*TASK, side.alias("_side")).select(*TASK, "_side.*")


def label_index(label_counts: DataFrame) -> DataFrame:
    """Index of each label of a task: most frequent in training first, ties by name.

    A window holds the labels of one task, two rows at most.
    """
    by_frequency = Window.partitionBy(*TASK).orderBy(F.col("n_train").desc(), "task_label")
    return (
        label_counts.filter(F.col("n_train") > 0)
        .withColumn("label_index", (F.row_number().over(by_frequency) - 1).cast("double"))
        .select(*TASK, "cut", "task_label", "n_train", "label_index")
    )


def trainable_tasks(indexed_labels: DataFrame) -> DataFrame:
    """Tasks with two training labels, with the index of ``class1``."""
    return (
        indexed_labels.groupBy(*TASK, "cut")
        .agg(
            F.count(F.lit(1)).alias("labels"),
            F.sum("n_train").alias("n_train"),
            F.max(F.when(F.col("task_label") == F.col("class1"), F.col("label_index"))).cast("int").alias("class1_index"),
        )
        .filter(F.col("labels") == 2)
        .drop("labels")
    )


def untrainable_tasks(label_counts: DataFrame) -> DataFrame:
    """Tasks with fewer than two labels on the training side; reported, not trained."""
    return (
        label_counts.groupBy(*TASK)
        .agg(F.count_if(F.col("n_train") > 0).alias("train_labels"))
        .filter(F.col("train_labels") < 2)
    )
