"""The registered queries: every operator over the given tables.

Vectors come from ``embeddings``: classes are the letters from ``a``, an image is
named ``<class>_<vec_id>.jpg.json``, and vectors are scaled by 10 so that training
moves. The second source holds the vectors at coarser precision: three of four under
the same image names, the others under names of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.fixed_values import (
    LISTED_COLUMN,
    LISTED_IMAGES,
    PAIR_TRAIN_PERCENT,
    REST_TRAIN_PERCENT,
    SECOND_SOURCE_TRAIN_PERCENT,
    SWEEP_TRAIN_PERCENTS,
)
from ..functions.names import curve_name, label_from_file_name
from ..functions.vectors import parse_vector, vector_text
from ..operators.classes import (
    TASK,
    class_list,
    class_pairs,
    filter_pair,
    grid_points,
    relabel_rest,
    rest_tasks,
    task_table,
)
from ..operators.images import pair_image_index, rest_image_index
from ..operators.indexing import apply_index, string_index
from ..operators.misclassified import LISTED_BY, first_images, misclassified, misclassified_by_vector
from ..operators.scoring import predict, prediction_metrics, right, second_source_rows
from ..operators.selection import (
    best_model_reports,
    best_models,
    fraction_curve,
    iteration_curve,
    last_fraction,
    model_reports,
)
from ..operators.splits import bucket_counts, label_index, split_counts, task_label_counts, with_bucket
from ..operators.svm import model_weights
from ..operators.words import word_run_totals, word_totals
from ..session import new_table_path, write_table
from ..sources.count_lines import parse_count_lines
from ..sources.feature_files import (
    parse_feature_records,
    read_feature_files,
    two_sources,
    write_feature_files,
)
from ..sources.result_files import best_model_json, write_best_models_object
from ..streaming.count_lines import totals_of_available
from .tournament import Tournament, run_sweep, run_tournament

# ---------------------------------------------------------------- inputs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _features(spark: SparkSession, sf_dir: str, number: Callable[[Column], Column], own: Column) -> DataFrame:
    """``own`` tells the rows whose name no other source has."""
    name = F.char(F.col("label") + 97)
    ending = F.when(own, "_2.jpg.json").otherwise(".jpg.json")
    return _table(spark, sf_dir, "embeddings").select(
        name.alias("label"),
        F.transform("embedding", number).alias("features"),
        F.concat(name, F.lit("_"), F.col("vec_id").cast("string"), ending).alias("images"),
    )


def main_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, lambda v: v.cast("double") * 10, F.lit(False))


def second_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir, lambda v: F.floor(v.cast("double") * 10).cast("double"), F.col("vec_id") % 4 == 3)


def _count_line() -> Column:
    return F.concat(F.lit(" "), F.col("event_type"), F.lit("\t"), F.col("user_id").cast("string"))


def count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ``word count`` lines, with their position."""
    return _table(spark, sf_dir, "events").select("event_id", _count_line().alias("value"))


# ---------------------------------------------------------------- trained runs

_runs: dict[tuple, Tournament] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """Tells a run by its input files, so that changed tables are trained on anew."""
    files = _table(spark, sf_dir, "embeddings").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time"
    )
    # Sums that do not hang on an order, so that no row or task holds all files.
    file = F.xxhash64(*files.columns)
    sums = files.distinct().agg(
        F.count(F.lit(1)), F.sum(F.shiftright(file, 20)), F.bit_xor(file), F.sum("file_size"), F.max("file_modification_time")
    )
    digest = tuple(sums.first())
    return spark.sparkContext.applicationId, sf_dir, name, digest


def tournament(spark: SparkSession, sf_dir: str) -> Tournament:
    """Both kinds of task at their standard shares, trained once per application."""
    key = _key(spark, sf_dir, "standard")
    if key not in _runs:
        _runs[key] = run_tournament(main_source(spark, sf_dir), second_source(spark, sf_dir))
    return _runs[key]


def sweep(spark: SparkSession, sf_dir: str) -> Tournament:
    """Both kinds of task at all shares of the sweep, trained once per application."""
    key = _key(spark, sf_dir, "sweep")
    if key not in _runs:
        _runs[key] = run_sweep(main_source(spark, sf_dir), second_source(spark, sf_dir))
    return _runs[key]


def forget_runs(sweeps: bool = False) -> None:
    """Train the standard runs, or those of the sweep, again on the next use."""
    for key in [k for k in _runs if (k[2] == "sweep") == sweeps]:
        del _runs[key]


# ---------------------------------------------------------------- sources and text


def odd_name(images: Column) -> Column:
    """Some names as file systems allow them: hidden ones, with a space, signs, letters."""
    number = F.regexp_extract(images, "([0-9]+)", 1).cast("int") % 40
    return (
        F.when(number == 1, F.concat(F.lit("_"), images))
        .when(number == 2, F.concat(F.lit("."), images))
        .when(number == 3, F.concat(F.lit("great dane%20+é"), images))
        .otherwise(images)
    )


def feature_scan(spark, sf_dir):
    named = main_source(spark, sf_dir).withColumn("images", odd_name(F.col("images")))
    records = named.select("images", vector_text(F.col("features")).alias("value"))
    path = new_table_path(spark, "feature-files")
    write_feature_files(records, path)
    return read_feature_files(spark, path).select(
        "images", "label", F.size("features").alias("n_features"),
        F.element_at("features", 1).alias("first_number"), F.element_at("features", -1).alias("last_number"),
    )


def feature_table(spark, sf_dir):
    records = main_source(spark, sf_dir).select("images", vector_text(F.col("features")).alias("value"))
    return parse_feature_records(records).select("images", "label", F.size("features").alias("n_features"))


def two_source_union(spark, sf_dir):
    both = two_sources(main_source(spark, sf_dir), second_source(spark, sf_dir))
    return both.groupBy("source", "label").agg(F.count(F.lit(1)).alias("n"))


def label_parse(spark, sf_dir):
    return main_source(spark, sf_dir).select("images", label_from_file_name(F.col("images")).alias("label"))


def vector_parse(spark, sf_dir):
    text = main_source(spark, sf_dir).select("images", vector_text(F.col("features")).alias("line"))
    return text.select("images", F.posexplode(parse_vector(F.col("line"))).alias("k", "v"))


# ---------------------------------------------------------------- classes and tasks


def class_list_query(spark, sf_dir):
    return class_list(main_source(spark, sf_dir))


def class_pairs_query(spark, sf_dir):
    return class_pairs(main_source(spark, sf_dir))


def ova_tasks(spark, sf_dir):
    return rest_tasks(main_source(spark, sf_dir))


def _all_tasks(features: DataFrame) -> DataFrame:
    return task_table(features, SWEEP_TRAIN_PERCENTS, [*SWEEP_TRAIN_PERCENTS, REST_TRAIN_PERCENT])


def grid_points_query(spark, sf_dir):
    tasks = task_table(main_source(spark, sf_dir), [PAIR_TRAIN_PERCENT], [REST_TRAIN_PERCENT])
    return grid_points(tasks.select("kind", "class1", "class2"))


def task_keys(spark, sf_dir):
    return _all_tasks(main_source(spark, sf_dir)).select(
        *TASK, "task", curve_name(F.col("train_fraction"), F.col("class1"), F.col("class2")).alias("curve")
    )


def pair_filter(spark, sf_dir):
    features = main_source(spark, sf_dir)
    sizes = features.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    sides = class_pairs(features).withColumn("label", F.explode(F.array("class1", "class2")))
    return sides.join(sizes, "label").select("class1", "class2", "label", "n")


def pair_filter_rows(spark, sf_dir):
    return filter_pair(main_source(spark, sf_dir), "a", "b").select("images", "label")


def ova_relabel_rows(spark, sf_dir):
    return relabel_rest(main_source(spark, sf_dir), "a").select("images", "label")


def ova_relabel(spark, sf_dir):
    # Share 0 trains on nothing, so every row counts on the test side.
    counts = write_table(bucket_counts(with_bucket(main_source(spark, sf_dir))), "bucket-counts")
    sides = task_label_counts(counts, task_table(counts, rest_percents=[0]))
    return sides.select("class1", F.col("task_label").alias("label"), F.col("n_test").alias("n"))


# ---------------------------------------------------------------- splits and indices


def _label_counts(spark, sf_dir):
    # The rows are read once; tasks and sizes come from the small count table.
    counts = write_table(bucket_counts(with_bucket(main_source(spark, sf_dir))), "bucket-counts")
    return task_label_counts(counts, _all_tasks(counts))


def split_counts_query(spark, sf_dir):
    return split_counts(_label_counts(spark, sf_dir))


def label_index_query(spark, sf_dir):
    return label_index(_label_counts(spark, sf_dir)).select(
        *TASK, F.col("task_label").alias("label"), "n_train", "label_index"
    )


def image_index(spark, sf_dir):
    features = main_source(spark, sf_dir)
    return pair_image_index(features, task_table(features, [PAIR_TRAIN_PERCENT]))


def image_index_rest(spark, sf_dir):
    return rest_image_index(main_source(spark, sf_dir), [*SWEEP_TRAIN_PERCENTS, REST_TRAIN_PERCENT])


def index_sample(spark, sf_dir):
    sample = _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("category"))
    index = string_index(sample, "category", "categoryIndex")
    return apply_index(sample, index, "category", "categoryIndex").select("id", "category", "categoryIndex")


# ---------------------------------------------------------------- models


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("accuracy", F.round("accuracy", 6)).withColumn("error_rate", F.round("error_rate", 6))


def svm_weights(spark, sf_dir):
    weights = model_weights(tournament(spark, sf_dir).models)
    return weights.select(*TASK, "numIter", "k", F.round("w", 6).alias("w"))


def _predictions(spark, sf_dir, kind):
    models = tournament(spark, sf_dir).models.filter(F.col("kind") == kind)
    return predict(main_source(spark, sf_dir), models)


def predictions_ovo(spark, sf_dir):
    return _predictions(spark, sf_dir, "1vs1").select(
        *TASK, "numIter", "images", "label_index", "label_index_predicted"
    )


def predictions_ova(spark, sf_dir):
    return _predictions(spark, sf_dir, "1vsAll").select(
        *TASK, "numIter", "images", "label_index", "label_index_predicted"
    )


def hits_ovo(spark, sf_dir):
    hits = right(_predictions(spark, sf_dir, "1vs1"))
    return hits.groupBy(*TASK, "numIter").agg(F.count(F.lit(1)).alias("hits"))


def accuracy_ovo(spark, sf_dir):
    metrics = prediction_metrics(_predictions(spark, sf_dir, "1vs1"), [*TASK, "model_number", "numIter"])
    return _rounded(metrics)


def _metrics(run: Tournament, *conditions: str) -> DataFrame:
    metrics = run.metrics
    for condition in conditions:
        metrics = metrics.filter(condition)
    return _rounded(metrics.select(
        *TASK, "model_number", "numIter", "eval_set", "hits", "errors", "total", "accuracy", "error_rate"
    ))


def accuracy_ova(spark, sf_dir):
    return _metrics(tournament(spark, sf_dir), "kind = '1vsAll'", "eval_set = 'test'").drop("eval_set")


def accuracy_ova_all(spark, sf_dir):
    return _metrics(tournament(spark, sf_dir), "kind = '1vsAll'", "eval_set = 'all'").drop("eval_set")


def grid_accuracy(spark, sf_dir):
    return _metrics(tournament(spark, sf_dir))


def sweep_accuracy(spark, sf_dir):
    return _metrics(sweep(spark, sf_dir))


def curve_iterations(spark, sf_dir):
    curve = iteration_curve(sweep(spark, sf_dir).metrics)
    return curve.select(*TASK, "curve", "eval_set", "numIter", F.round("accuracy", 6).alias("accuracy"))


def best_model(spark, sf_dir):
    return _rounded(best_models(tournament(spark, sf_dir).metrics))


def best_model_last_fraction(spark, sf_dir):
    return _rounded(last_fraction(best_models(sweep(spark, sf_dir).metrics)))


def best_models_json(spark, sf_dir):
    return best_models(tournament(spark, sf_dir).metrics).select("task", best_model_json().alias("record"))


def best_models_object(spark, sf_dir):
    path = new_table_path(spark, "best-models-object")
    write_best_models_object(best_models(tournament(spark, sf_dir).metrics), path)
    member = r'^"(.*)": (\{.*\}),?$'
    lines = spark.read.text(path).filter(F.col("value").rlike(member))
    return lines.select(
        F.regexp_extract("value", member, 1).alias("task"), F.regexp_extract("value", member, 2).alias("record")
    )


def model_report_query(spark, sf_dir):
    return model_reports(tournament(spark, sf_dir).metrics)


def best_model_report_query(spark, sf_dir):
    return best_model_reports(best_models(tournament(spark, sf_dir).metrics))


def curve_fraction(spark, sf_dir):
    return fraction_curve(best_models(sweep(spark, sf_dir).metrics)).withColumn("accuracy", F.round("accuracy", 6))


# ---------------------------------------------------------------- errors


def misclassified_query(spark, sf_dir):
    return first_images(misclassified(main_source(spark, sf_dir), tournament(spark, sf_dir).models))


def misclassified_counts(spark, sf_dir):
    errors = misclassified(main_source(spark, sf_dir), sweep(spark, sf_dir).models)
    return errors.groupBy("images").agg(F.count(F.lit(1)).alias("errors"))


def misclassified_all(spark, sf_dir):
    models = tournament(spark, sf_dir).models.filter("kind = '1vsAll'")
    rows = second_source_rows(
        second_source(spark, sf_dir), main_source(spark, sf_dir), SECOND_SOURCE_TRAIN_PERCENT, REST_TRAIN_PERCENT
    )
    errors = predict(rows, models, errors_only=True)
    return errors.select(*TASK, "numIter", "images", "label_index", "label_index_predicted")


def misclassified_by_vector_query(spark, sf_dir):
    listed = misclassified_by_vector(main_source(spark, sf_dir), tournament(spark, sf_dir).models, listed=LISTED_IMAGES)
    return listed.select(*LISTED_BY, F.col("images").alias(LISTED_COLUMN), "times_listed")


# ---------------------------------------------------------------- words


def word_totals_query(spark, sf_dir):
    return word_totals(parse_count_lines(count_lines(spark, sf_dir)))


def word_run_totals_query(spark, sf_dir):
    lines = parse_count_lines(count_lines(spark, sf_dir), keep=("event_id",))
    return word_run_totals(lines, "event_id")


def word_totals_stream(spark, sf_dir):
    schema = _table(spark, sf_dir, "events").schema
    # A stream takes a single file only as what a pattern finds; this one finds that name.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.[p]arquet")
    return totals_of_available(parse_count_lines(events.select(_count_line().alias("value"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feature_scan": feature_scan,
    "feature_table": feature_table,
    "two_source_union": two_source_union,
    "label_parse": label_parse,
    "vector_parse": vector_parse,
    "class_list": class_list_query,
    "class_pairs": class_pairs_query,
    "ova_tasks": ova_tasks,
    "grid_points": grid_points_query,
    "task_keys": task_keys,
    "pair_filter": pair_filter,
    "ova_relabel": ova_relabel,
    "pair_filter_rows": pair_filter_rows,
    "ova_relabel_rows": ova_relabel_rows,
    "split_counts": split_counts_query,
    "label_index": label_index_query,
    "image_index": image_index,
    "image_index_rest": image_index_rest,
    "index_sample": index_sample,
    "svm_weights": svm_weights,
    "predictions_ovo": predictions_ovo,
    "predictions_ova": predictions_ova,
    "hits_ovo": hits_ovo,
    "accuracy_ovo": accuracy_ovo,
    "accuracy_ova": accuracy_ova,
    "accuracy_ova_all": accuracy_ova_all,
    "grid_accuracy": grid_accuracy,
    "sweep_accuracy": sweep_accuracy,
    "curve_iterations": curve_iterations,
    "best_model": best_model,
    "best_model_last_fraction": best_model_last_fraction,
    "best_models_json": best_models_json,
    "best_models_object": best_models_object,
    "model_report": model_report_query,
    "best_model_report": best_model_report_query,
    "curve_fraction": curve_fraction,
    "misclassified": misclassified_query,
    "misclassified_counts": misclassified_counts,
    "misclassified_all": misclassified_all,
    "misclassified_by_vector": misclassified_by_vector_query,
    "word_totals": word_totals_query,
    "word_run_totals": word_run_totals_query,
    "word_totals_stream": word_totals_stream,
}
