"""The command-line programs: classify feature directories, total word counts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.fixed_values import (
    PAIR_TRAIN_PERCENT,
    REST_TRAIN_PERCENT,
    SECOND_SOURCE_TRAIN_PERCENT,
    SWEEP_TRAIN_PERCENTS,
)
from ..operators.classes import Grid
from ..operators.misclassified import first_images, misclassified
from ..operators.selection import (
    best_model_reports,
    best_models,
    fraction_curve,
    iteration_curve,
    last_fraction,
    model_reports,
)
from ..operators.splits import split_counts, with_bucket
from ..operators.words import word_totals
from ..session import write_table
from ..sources.count_lines import read_count_lines, write_total_lines
from ..sources.feature_files import read_feature_files, read_rejects
from ..sources.result_files import write_best_models, write_best_models_object, write_curve, write_report
from .tournament import Tournament, run_tournament


def classify(
    spark: SparkSession, features_dir: str, second_dir: str, out: str, sweep: bool = False,
    strict: bool = False, grid: Grid = Grid(), seed: str = "",
) -> Tournament:
    """Train all tasks on the first directory and write every result below ``out``.

    The second directory is the further evaluation set of the one-against-the-rest
    models. ``sweep`` repeats both kinds of task at every training share.
    """
    # Small text files are read and parsed once; everything later reads the table.
    features = write_table(read_feature_files(spark, features_dir, strict), "features")
    second = write_table(read_feature_files(spark, second_dir, strict), "features-second")
    run = run_tournament(
        features,
        second,
        SWEEP_TRAIN_PERCENTS if sweep else [PAIR_TRAIN_PERCENT],
        SWEEP_TRAIN_PERCENTS if sweep else [REST_TRAIN_PERCENT],
        None if sweep else SECOND_SOURCE_TRAIN_PERCENT,
        grid,
        seed,
    )
    best = best_models(run.metrics)
    surviving = last_fraction(best)
    read_rejects(spark, features_dir).write.parquet(f"{out}/rejects")
    split_counts(run.label_counts).write.parquet(f"{out}/split_counts")
    run.untrained.write.parquet(f"{out}/untrained_tasks")
    run.metrics.write.parquet(f"{out}/metrics")
    write_report(model_reports(run.metrics), f"{out}/model_report")
    write_report(best_model_reports(best), f"{out}/best_model_report")
    write_curve(iteration_curve(run.metrics), f"{out}/curve_iterations")
    write_curve(fraction_curve(best), f"{out}/curve_fraction")
    first_images(misclassified(with_bucket(features, seed), run.models)).write.json(f"{out}/misclassified")
    write_best_models(surviving, f"{out}/best_models")
    write_best_models_object(surviving, f"{out}/best_classifiers")
    return run


def total_words(spark: SparkSession, path: str, out: str) -> None:
    """Totals of ``word count`` lines as text."""
    write_total_lines(word_totals(read_count_lines(spark, path)), out)
