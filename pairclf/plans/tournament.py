"""Whole runs: all pairs, all classes against the rest, and the sweep of shares."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import (
    PAIR_TRAIN_PERCENT,
    REST_TRAIN_PERCENT,
    SECOND_SOURCE_TRAIN_PERCENT,
    SWEEP_TRAIN_PERCENTS,
)
from ..operators.blocks import in_larger_parts, pack_blocks, vector_size
from ..operators.classes import Grid, task_table
from ..operators.scoring import METRICS, evaluate, second_source_rows
from ..operators.splits import (
    bucket_counts,
    label_index,
    task_label_counts,
    trainable_tasks,
    untrainable_tasks,
    with_bucket,
)
from ..operators.svm import CHUNK_BYTES, train
from ..session import write_table


class Tournament:
    """Written tables of one run: counts per task label, models, and, scored when they
    are first asked for, metrics."""

    def __init__(self, label_counts: DataFrame, models: DataFrame, score: Callable[[], DataFrame]):
        self.label_counts = label_counts
        self.models = models
        self._score = score

    @cached_property
    def metrics(self) -> DataFrame:
        return self._score()

    @property
    def untrained(self) -> DataFrame:
        return untrainable_tasks(self.label_counts)


def run_tournament(
    features: DataFrame,
    second: DataFrame | None = None,
    pair_percents: Sequence[int] = (PAIR_TRAIN_PERCENT,),
    rest_percents: Sequence[int] = (REST_TRAIN_PERCENT,),
    second_percent: int | None = SECOND_SOURCE_TRAIN_PERCENT,
    grid: Grid = Grid(),
    seed: str = "",
) -> Tournament:
    """Train all tasks at all shares, to be scored on demand.

    ``second`` is a further source that the one-against-the-rest models are also
    scored on, as ``eval_set`` ``all``; models are chosen on ``test`` alone. Another
    ``seed`` is another split of both sources.
    """
    # Classes, split sizes and label frequencies all come from this small table, so
    # the rows are read once for counting and once for packing.
    bucketed = with_bucket(features, seed)
    counts = write_table(bucket_counts(bucketed), "bucket-counts")
    tasks = write_table(task_table(counts, pair_percents, rest_percents), "tasks")
    label_counts = write_table(task_label_counts(counts, tasks), "label-counts")
    largest_cut = max([*pair_percents, *rest_percents, 0])
    size = vector_size(features)
    trainable = trainable_tasks(label_index(label_counts))
    rows, runs = counts.agg(F.sum("n")).first()[0], tasks.count() * len(grid.parameters())
    parts = in_larger_parts(bucketed, 8 * size * rows, min(CHUNK_BYTES, 8 * size * runs))
    blocks = pack_blocks(parts, size, largest_cut)
    models = train(blocks, trainable, size, grid)
    blocks.unpersist()

    def score() -> DataFrame:
        tested = pack_blocks(bucketed, size, largest_cut)
        metrics = evaluate(tested, models)
        second_blocks = None
        if second is not None:
            rows = second_source_rows(second, features, second_percent, largest_cut, seed)
            second_blocks = pack_blocks(rows, size, largest_cut)
            metrics = metrics.unionByName(evaluate(second_blocks, models.filter("kind = '1vsAll'"), "all"))
        metrics = write_table(metrics.select(METRICS), "metrics")
        tested.unpersist()
        if second_blocks is not None:
            second_blocks.unpersist()
        return metrics

    return Tournament(label_counts, models, score)


def run_sweep(features: DataFrame, second: DataFrame | None = None, grid: Grid = Grid(), seed: str = "") -> Tournament:
    """Both kinds of task at every share of the sweep; both sources split alike."""
    return run_tournament(
        features, second, SWEEP_TRAIN_PERCENTS, SWEEP_TRAIN_PERCENTS, second_percent=None, grid=grid, seed=seed
    )
