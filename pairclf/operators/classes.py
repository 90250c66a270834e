"""Classes, tasks and grid points as tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import ITERATIONS, REG_PARAMS, REST_LABEL, STEP_SIZES
from ..functions.names import task_key

TASK = ["kind", "class1", "class2", "train_fraction"]
#: Blocks of classes; pairs are made in the cells of two blocks.
PAIR_BLOCKS = 16


@dataclass(frozen=True)
class Grid:
    """Training parameters to try; numbered in product order, iterations first."""

    iterations: Sequence[int] = field(default_factory=lambda: list(ITERATIONS))
    step_sizes: Sequence[float] = field(default_factory=lambda: list(STEP_SIZES))
    reg_params: Sequence[float] = field(default_factory=lambda: list(REG_PARAMS))

    def parameters(self) -> list[tuple[float, float]]:
        """Step size and regularisation of every run; iteration limits are its snapshots."""
        return [(float(step), float(reg)) for step in self.step_sizes for reg in self.reg_params]

    def numbers(self) -> dict[tuple[int, float, float], int]:
        """Model number of every grid point."""
        points = [(int(limit), *parameters) for limit in self.iterations for parameters in self.parameters()]
        return {point: number for number, point in enumerate(points, start=1)}


def class_list(features: DataFrame) -> DataFrame:
    """The distinct classes in order."""
    return features.select("label").distinct().orderBy("label")


def class_pairs(features: DataFrame) -> DataFrame:
    """Each unordered pair of classes once, ``class1 < class2``.

    Classes are dealt to ``PAIR_BLOCKS`` blocks by a hash. A class goes to the cells of its
    block's row as ``class1`` and to those of its column as ``class2``, so that any two
    classes meet in one cell: an equi-join on the cell, with no order over all classes and
    no task that holds the catalogue whole.
    """
    block = F.pmod(F.xxhash64("label"), F.lit(PAIR_BLOCKS)).cast("int")
    dealt = features.select("label").distinct().select("label", block.alias("own"))
    others = F.explode(F.sequence(F.lit(0), F.lit(PAIR_BLOCKS - 1)))
    first = dealt.select(F.col("label").alias("class1"), F.col("own").alias("row"), others.alias("column"))
    second = dealt.select(F.col("label").alias("class2"), others.alias("row"), F.col("own").alias("column"))
    return first.join(second, ["row", "column"]).filter("class1 < class2").select("class1", "class2")


def rest_tasks(features: DataFrame) -> DataFrame:
    """One class-against-the-rest task per class."""
    return features.select(F.col("label").alias("class1")).distinct().withColumn("class2", F.lit(REST_LABEL))


def task_table(
    features: DataFrame, pair_percents: Sequence[int] = (), rest_percents: Sequence[int] = ()
) -> DataFrame:
    """All tasks of both kinds at the given training shares.

    ``cut`` is the share in percent: buckets below it train, the others test.
    """

    def at(tasks: DataFrame, kind: str, percents: Sequence[int]) -> DataFrame:
        cuts = F.explode(F.array(*[F.lit(int(p)) for p in percents]))
        return tasks.select(F.lit(kind).alias("kind"), "class1", "class2", cuts.alias("cut"))

    parts = []
    if pair_percents:
        parts.append(at(class_pairs(features), "1vs1", pair_percents))
    if rest_percents:
        parts.append(at(rest_tasks(features), "1vsAll", rest_percents))
    if not parts:
        raise ValueError("no training share given for either kind of task")
    tasks = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return tasks.select(
        "kind", "class1", "class2", (F.col("cut") / 100).alias("train_fraction"), "cut",
        task_key(F.col("class1"), F.col("class2")).alias("task"),
    )


def grid_points(tasks: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Every task with every numbered grid point."""
    points = F.array(*[
        F.struct(
            F.lit(number).alias("model_number"), F.lit(limit).alias("numIter"),
            F.lit(step).alias("stepSize"), F.lit(reg).alias("regParam"),
        )
        for (limit, step, reg), number in grid.numbers().items()
    ])
    return tasks.withColumn("_point", F.explode(points)).select(*tasks.columns, "_point.*")


def filter_pair(features: DataFrame, class1: str, class2: str) -> DataFrame:
    """The rows of either class."""
    return features.filter(F.col("label").isin(class1, class2))


def relabel_rest(features: DataFrame, class1: str) -> DataFrame:
    """All rows; the label stays for ``class1`` and becomes ``All`` elsewhere."""
    label = F.when(F.col("label") == class1, F.col("label")).otherwise(F.lit(REST_LABEL))
    return features.withColumn("label", label)
