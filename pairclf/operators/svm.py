"""Linear support-vector training by gradient descent, all tasks in one pass.

With ``s`` = +1/-1 for index 1/0, ``n`` training rows and ``w`` = 0 at the start,
iteration ``i`` takes the rows with ``s * (w.x) < 1`` as active and sets

    w <- w * (1 - eta * reg) + eta / n * sum(active s * x),   eta = step / sqrt(i)

There is no intercept, and a run stops from the second iteration on once ``w``
moves by less than ``tolerance * max(|w|, 1)``. Start and schedule do not depend
on the iteration limit, so all limits of a grid are snapshots of one run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import TOLERANCE
from ..session import new_table_path
from .classes import TASK, Grid

MODEL_SCHEMA = (
    "model_id bigint, kind string, class1 string, class2 string, train_fraction double, cut int, "
    "class1_index int, model_number int, numIter int, stepSize double, regParam double, "
    "iterations_run int, weights array<double>"
)
# Bound of the weights that one chunk of runs may take; further runs are trained in
# further chunks. Only a chunk's weights and sums are ever in the driver.
CHUNK_BYTES = 64 * 1024 * 1024
# Bound of the weights that a task holds ready by label.
READY_BYTES = 128 * 1024 * 1024
# Partial sums of all partitions that are added in the driver; more of them are added in
# tasks of about as many bytes. Both add in the order of the partitions.
GATHERED_BYTES = 64 * 1024 * 1024


def train(
    blocks: DataFrame,
    tasks: DataFrame,
    size: int,
    grid: Grid = Grid(),
    tolerance: float = TOLERANCE,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Train every task at every grid point; returns the written table of models.

    ``tasks`` is :func:`splits.trainable_tasks`; ``blocks`` is
    :func:`blocks.pack_blocks`. Rows stay where they are: an iteration is one job, in
    which the weights of a chunk of runs go to the rows and every partition makes one
    partial sum for each run. Partial sums are added in the order of the partitions, so
    that reruns agree: in the driver where all of them fit into ``GATHERED_BYTES``, else
    by a shuffle on the run. Tasks are chunked in tiles of classes, and a pass reads the
    blocks of the classes that its live runs name.
    """
    spark = blocks.sparkSession
    path = new_table_path(spark, "models")
    model_table = _kernels().model_table
    spark.createDataFrame([], MODEL_SCHEMA).write.parquet(path)
    parameters = grid.parameters()
    per_run = 8 * size * (len(grid.iterations) + 3)
    in_chunk = max(1, chunk_bytes // (per_run * len(parameters)))
    remaining = _in_tiles(tasks, in_chunk).toLocalIterator()
    parts = blocks.rdd.getNumPartitions()
    next_id = 0
    while chunk := list(islice(remaining, in_chunk)):
        runs = [(task.asDict(), step, reg) for task in chunk for step, reg in parameters]
        for limit, weights, iterations_run in _passes(blocks, parts, runs, size, grid, tolerance):
            table = model_table(runs, grid.numbers(), limit, weights, iterations_run)
            ids = pa.array(range(next_id, next_id + table.num_rows), pa.int64())
            next_id += table.num_rows
            table = pa.Table.from_batches([table]).add_column(0, "model_id", ids)
            spark.createDataFrame(table, MODEL_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(MODEL_SCHEMA).parquet(path)


def _in_tiles(tasks: DataFrame, in_chunk: int) -> DataFrame:
    """Tasks in tiles of classes, so that a chunk names few classes: with ``k`` parts
    of the classes a tile has a k-th of them on either side."""
    parts = max(1, math.isqrt(max(1, tasks.count() // in_chunk)))
    tile = [F.pmod(F.xxhash64(c), F.lit(parts)) for c in ("class1", "class2")]
    return tasks.orderBy("kind", *tile, *TASK)


def named_labels(tasks: list) -> list[str] | None:
    """The labels whose rows the tasks need; None when they need all."""
    if any(task["kind"] != "1vs1" for task in tasks):
        return None
    return sorted({task[side] for task in tasks for side in ("class1", "class2")})


def _passes(
    blocks: DataFrame, parts: int, runs: list, size: int, grid: Grid, tolerance: float
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (iteration limit, weights, iterations run) for every limit of the grid."""
    kernels = _kernels()
    context = blocks.sparkSession.sparkContext
    membership = context.broadcast(label_membership([task for task, _, _ in runs]))

    def sums_of(weights, live):
        alive = [task for (task, _, _), on in zip(runs, live) if on]
        rows = blocks.filter(F.col("min_bucket") < max(task["cut"] for task in alive))
        labels = named_labels(alive)
        if labels is not None:
            rows = rows.filter(F.col("label").isin(labels))
        shared = context.broadcast((weights, live))
        try:
            partials = rows.mapInArrow(_partial_sums(membership, shared), "run int, part int, sums binary")
            partial_bytes = parts * len(alive) * 8 * size
            if partial_bytes <= GATHERED_BYTES:
                added = partials.toArrow().sort_by([("run", "ascending"), ("part", "ascending")])
            else:
                adders = min(len(alive), math.ceil(partial_bytes / GATHERED_BYTES))
                in_order = partials.repartition(adders, "run").sortWithinPartitions("run", "part")
                added = in_order.mapInArrow(_sum_adder(), "run int, sums binary").toArrow()
        finally:
            shared.destroy()
        total = np.zeros_like(weights)
        for batch in added.to_batches():
            for run, sums in zip(batch.column("run").to_pylist(), batch.column("sums")):
                total[run] += np.frombuffer(sums.as_buffer())
        return total

    try:
        yield from kernels.descend(runs, size, list(grid.iterations), tolerance, sums_of)
    finally:
        membership.destroy()


def _kernels():
    """The small numeric functions of the training.

    Made here so that they travel with the functions that run in the tasks.
    """

    def descend(runs, size, limits, tolerance, sums_of):
        """The iterations; ``sums_of(weights, live)`` makes the sums over active rows."""
        import numpy as np

        steps = np.array([step for _, step, _ in runs])
        regs = np.array([reg for _, _, reg in runs])
        n_train = np.array([task["n_train"] for task, _, _ in runs], dtype=float)
        weights = np.zeros((len(runs), size))
        live = np.ones(len(runs), dtype=bool)
        iterations_run = np.zeros(len(runs), dtype="i4")
        for iteration in range(1, max(limits) + 1):
            if live.any():
                eta = steps / np.sqrt(iteration)
                moved = weights * (1 - eta * regs)[:, None] + (eta / n_train)[:, None] * sums_of(weights, live)
                moved = np.where(live[:, None], moved, weights)
                iterations_run[live] = iteration
                if iteration > 1:
                    change = np.linalg.norm(moved - weights, axis=1)
                    live = live & ~(change < tolerance * np.maximum(np.linalg.norm(moved, axis=1), 1.0))
                weights = moved
            if iteration in limits:
                yield iteration, weights, iterations_run.copy()

    def add_block(sums, buckets, vectors, members):
        """Add the active ``s * x`` of one block to the sums of the tasks of its label."""
        import numpy as np

        for cut, numbers, signs, weights in members:
            in_train = np.searchsorted(buckets, cut)
            if not in_train or not len(numbers):
                continue
            # A slice of rows at a time keeps the margins within 32 MB.
            width = max(1, 4_000_000 // len(numbers))
            for start in range(0, in_train, width):
                rows = vectors[start:min(start + width, in_train)]
                active = (rows @ weights.T) * signs < 1
                sums[numbers] += signs[:, None] * (active.T.astype(float) @ rows)

    def live_members(members, live, weights):
        """Members as (cut, numbers of the runs still live, signs +1/-1, their weights)."""
        return [(cut, n[live[n]], 2.0 * i[live[n]] - 1, weights[n[live[n]]]) for cut, n, i in members]

    def model_table(runs, model_numbers, limit, weights, iterations_run):
        """Models of one iteration limit as an Arrow batch."""
        import numpy as np
        import pyarrow as pa

        count, size = weights.shape
        tasks = [task for task, _, _ in runs]
        offsets = pa.array(np.arange(0, (count + 1) * size, size), pa.int32())
        return pa.RecordBatch.from_pydict({
            **{name: [task[name] for task in tasks] for name in ("kind", "class1", "class2", "train_fraction")},
            "cut": pa.array([task["cut"] for task in tasks], pa.int32()),
            "class1_index": pa.array([task["class1_index"] for task in tasks], pa.int32()),
            "model_number": pa.array([model_numbers[limit, step, reg] for _, step, reg in runs], pa.int32()),
            "numIter": pa.array([limit] * count, pa.int32()),
            "stepSize": pa.array([float(step) for _, step, _ in runs]),
            "regParam": pa.array([float(reg) for _, _, reg in runs]),
            "iterations_run": pa.array(iterations_run, pa.int32()),
            "weights": pa.ListArray.from_arrays(offsets, pa.array(weights.ravel())),
        })

    return SimpleNamespace(descend=descend, add_block=add_block, live_members=live_members, model_table=model_table)


def label_membership(tasks: list) -> dict:
    """Which tasks the rows of a label belong to, and with which label index."""
    return membership_function()(tasks)


def membership_function():
    """The function tasks -> membership:

    ``own``: label -> cut -> (task numbers, indices), for the classes a task names.
    ``rest``: cut -> (task numbers, index of the rest, class1), for the rest tasks,
    whose rest side holds every label but ``class1``.
    """

    def membership(tasks):
        import numpy as np

        own: dict = {}
        rest: dict = {}
        for number, task in enumerate(tasks):
            sides = [(task["class1"], task["class1_index"])]
            if task["kind"] == "1vs1":
                sides.append((task["class2"], 1 - task["class1_index"]))
            else:
                rest.setdefault(task["cut"], []).append((number, 1 - task["class1_index"], task["class1"]))
            for label, index in sides:
                own.setdefault(label, {}).setdefault(task["cut"], []).append((number, index))
        columns = lambda rows: tuple(np.array(column) for column in zip(*rows))
        return {
            "own": {label: {cut: columns(rows) for cut, rows in cuts.items()} for label, cuts in own.items()},
            "rest": {cut: columns(rows) for cut, rows in rest.items()},
        }

    return membership


def members_of_label():
    """The function (membership, label) -> [(cut, task numbers, label indices)].

    Made here so that it travels with the functions that run in the tasks.
    """

    def members(membership, label):
        import numpy as np

        own, rest = membership["own"].get(label, {}), membership["rest"]
        result = []
        for cut in sorted({*own, *rest}):
            numbers, indices = own.get(cut, (np.array([], "i8"), np.array([], "i8")))
            if cut in rest:
                others, other_indices, class1 = rest[cut]
                numbers = np.concatenate([numbers, others[class1 != label]])
                indices = np.concatenate([indices, other_indices[class1 != label]])
            result.append((cut, numbers, indices))
        return result

    return members


def _partial_sums(membership, shared):
    """The sums of active ``s * x`` over the blocks of one partition, per run, with the
    number of the partition. The weights of a label's runs are gathered once."""
    members, kernels, ready_bytes = members_of_label(), _kernels(), READY_BYTES

    def partial_sums(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        weights, live = shared.value
        sums = np.zeros_like(weights)
        known, held = {}, 0
        for batch in batches:
            columns = (batch.column(name) for name in ("label", "buckets", "vectors"))
            for label, raw_buckets, raw_vectors in zip(*columns):
                name = label.as_py()
                if name not in known:
                    if held > ready_bytes:
                        known, held = {}, 0
                    known[name] = kernels.live_members(members(membership.value, name), live, weights)
                    held += sum(ready.nbytes for *_, ready in known[name])
                buckets = np.frombuffer(raw_buckets.as_buffer(), dtype="u1")
                vectors = np.frombuffer(raw_vectors.as_buffer()).reshape(len(buckets), -1)
                kernels.add_block(sums, buckets, vectors, known[name])
        runs = np.flatnonzero(sums.any(axis=1))
        part = TaskContext.get().partitionId()
        for start in range(0, len(runs), 1024):
            slice_of = runs[start:start + 1024]
            yield pa.RecordBatch.from_pydict({
                "run": pa.array(slice_of, pa.int32()),
                "part": pa.array(np.full(len(slice_of), part), pa.int32()),
                "sums": pa.array([sums[run].tobytes() for run in slice_of], pa.binary()),
            })

    return partial_sums


def _sum_adder():
    """Adds up the partial sums of each run; its rows come together and in order."""

    def add_sums(batches):
        import numpy as np
        import pyarrow as pa

        def added(run, values):
            return pa.RecordBatch.from_pydict({
                "run": pa.array([run], pa.int32()), "sums": pa.array([values.tobytes()], pa.binary())
            })

        last, total = None, None
        for batch in batches:
            for run, sums in zip(batch.column("run").to_pylist(), batch.column("sums")):
                values = np.frombuffer(sums.as_buffer())
                if run == last:
                    total = total + values
                    continue
                if last is not None:
                    yield added(last, total)
                last, total = run, values
        if last is not None:
            yield added(last, total)

    return add_sums


def model_weights(models: DataFrame) -> DataFrame:
    """One row per model and vector position ``k`` (from 1)."""
    return models.select(
        *TASK, "numIter", "stepSize", "regParam", F.posexplode("weights").alias("k", "w")
    ).withColumn("k", F.col("k") + 1)
