"""Models applied to rows: predictions, hits and errors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import new_table_path, write_table
from .blocks import matrix_of_batch
from .classes import TASK
from .splits import with_bucket
from .svm import CHUNK_BYTES, label_membership, members_of_label, named_labels

MODEL = [*TASK, "model_number", "numIter", "stepSize", "regParam"]
MODEL_TYPES = dict(zip(MODEL, ("string", "string", "string", "double", "int", "int", "double", "double")))
METRICS = [*MODEL, "eval_set", "hits", "errors", "total", "accuracy", "error_rate"]


def _chunks(models: DataFrame, chunk_bytes: int) -> Iterator[tuple[list, tuple]]:
    """Models and (ids, weights, membership), as many at a time as ``chunk_bytes`` allows."""
    rows = models.select("model_id", "cut", "class1_index", "weights", *MODEL).orderBy("model_id").toLocalIterator()
    first = next(rows, None)
    if first is None:
        return
    in_chunk = max(1, chunk_bytes // (8 * max(1, len(first["weights"]))))
    part = [first, *islice(rows, in_chunk - 1)]
    while part:
        ids, weights = np.array([m["model_id"] for m in part]), np.array([m["weights"] for m in part])
        yield part, (ids, weights, label_membership(part))
        part = list(islice(rows, in_chunk))


def _of_chunk(rows: DataFrame, part: list) -> DataFrame:
    """The rows whose label the models of a chunk name."""
    labels = named_labels(part)
    return rows if labels is None else rows.filter(F.col("label").isin(labels))


def evaluate(blocks: DataFrame, models: DataFrame, eval_set: str = "test", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Accuracy, error rate and error count of every model on the test rows: those from
    the cut of the task on.

    One pass for the models of a chunk: each partition counts the hits of its blocks,
    and the sums of a chunk are written before the next one's models are sent.
    """
    spark = blocks.sparkSession
    path = new_table_path(spark, "hits")
    schema = "model_id bigint, hits bigint, total bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    for part, chunk in _chunks(models, chunk_bytes):
        shared = spark.sparkContext.broadcast(chunk)
        try:
            counts = _of_chunk(blocks, part).mapInArrow(_count_hits(shared), schema)
            sums = counts.groupBy("model_id").agg(F.sum("hits").alias("hits"), F.sum("total").alias("total"))
            sums.write.mode("append").parquet(path)
        finally:
            shared.destroy()
    counts = spark.read.schema(schema).parquet(path)
    counted = models.select("model_id", *MODEL).join(counts, "model_id", "left").fillna(0, ["hits", "total"])
    errors = F.col("total") - F.col("hits")
    total = F.nullif(F.col("total"), F.lit(0))
    return counted.select(
        *MODEL, F.lit(eval_set).alias("eval_set"), "hits", errors.alias("errors"), "total",
        (F.col("hits") / total).alias("accuracy"), (errors / total).alias("error_rate"),
    )


def predict(
    features: DataFrame, models: DataFrame, carry: Sequence[str] = ("images",), errors_only: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row per test row and model: index, predicted index, and the ``carry`` columns,
    beside what tells the model. A ``bucket`` column, if there is one, is kept as given.

    ``errors_only`` keeps the rows where the two differ, already in the pass. The rows
    of a chunk of models are written before the next chunk is sent.
    """
    spark = features.sparkSession
    bucketed = features if "bucket" in features.columns else with_bucket(features)
    rows = bucketed.select("label", "bucket", "features", *carry)
    schema = ", ".join([
        *[f"{name} {kind}" for name, kind in MODEL_TYPES.items()],
        "label_index double", "label_index_predicted int",
        *[f"`{name}` {features.schema[name].dataType.simpleString()}" for name in carry],
    ])
    path = new_table_path(spark, "predictions")
    spark.createDataFrame([], schema).write.parquet(path)
    for part, chunk in _chunks(models, chunk_bytes):
        shared = spark.sparkContext.broadcast((*chunk, {name: [m[name] for m in part] for name in MODEL}))
        try:
            predicted = _of_chunk(rows, part).mapInArrow(_predict_rows(shared, list(carry), errors_only), schema)
            predicted.write.mode("append").parquet(path)
        finally:
            shared.destroy()
    return spark.read.schema(schema).parquet(path)


def second_source_rows(
    second: DataFrame, features: DataFrame, own_percent: int | None, largest_cut: int, seed: str = ""
) -> DataFrame:
    """Rows of a second source to score, with a bucket that every cut compares right.

    The second source is split at its own share: rows from ``own_percent`` on are test
    rows. No image is scored by a task that trained on its name, so a name of the first
    source keeps its bucket, which the task's cut then bars; any other name passes
    every cut. Only buckets between the two shares need the comparison. Without an own
    share both sources are split alike.
    """
    rows = with_bucket(second, seed)
    if own_percent is None:
        return rows
    between = lambda df: df.filter((F.col("bucket") >= own_percent) & (F.col("bucket") < largest_cut))
    trained = write_table(between(with_bucket(features.select("images"), seed)).select("images").distinct(), "trained-names")
    own = between(rows).join(trained, "images", "left_anti").withColumn("bucket", F.lit(largest_cut))
    shared = between(rows).join(trained, "images", "left_semi")
    beyond = rows.filter(F.col("bucket") >= max(own_percent, largest_cut))
    return beyond.unionByName(own).unionByName(shared)


def wrong(predictions: DataFrame) -> DataFrame:
    """Predicted index differs from the actual one."""
    return predictions.filter(F.col("label_index_predicted") != F.col("label_index"))


def right(predictions: DataFrame) -> DataFrame:
    """Predicted index equals the actual one."""
    return predictions.filter(F.col("label_index_predicted") == F.col("label_index"))


def prediction_metrics(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The metrics of :func:`evaluate` from a table of predictions."""
    hits = F.count_if(F.col("label_index_predicted") == F.col("label_index"))
    errors = F.count_if(F.col("label_index_predicted") != F.col("label_index"))
    total = F.count(F.lit(1))
    return predictions.groupBy(*keys).agg(
        hits.alias("hits"), errors.alias("errors"), total.alias("total"),
        (hits / F.nullif(total, F.lit(0))).alias("accuracy"),
        (errors / F.nullif(total, F.lit(0))).alias("error_rate"),
    )


def _count_hits(shared):
    members = members_of_label()

    def count_hits(batches):
        import numpy as np
        import pyarrow as pa

        ids, weights, membership = shared.value
        hits = np.zeros(len(ids), dtype="i8")
        totals = np.zeros(len(ids), dtype="i8")
        known = {}
        for batch in batches:
            columns = (batch.column(name) for name in ("label", "buckets", "vectors"))
            for label, raw_buckets, raw_vectors in zip(*columns):
                name = label.as_py()
                if name not in known:
                    known[name] = members(membership, name)
                buckets = np.frombuffer(raw_buckets.as_buffer(), dtype="u1")
                vectors = np.frombuffer(raw_vectors.as_buffer()).reshape(len(buckets), -1)
                for cut, numbers, indices in known[name]:
                    first = np.searchsorted(buckets, cut)
                    if first == len(buckets) or not len(numbers):
                        continue
                    totals[numbers] += len(buckets) - first
                    width = max(1, 4_000_000 // len(numbers))
                    for start in range(first, len(buckets), width):
                        predicted = vectors[start:start + width] @ weights[numbers].T > 0
                        hits[numbers] += (predicted == indices).sum(axis=0)
        seen = totals > 0
        yield pa.RecordBatch.from_pydict({"model_id": ids[seen], "hits": hits[seen], "total": totals[seen]})

    return count_hits


def _predict_rows(shared, carry, errors_only):
    members, matrix_of = members_of_label(), matrix_of_batch()

    def predict_rows(batches):
        import numpy as np
        import pyarrow as pa

        _, weights, membership, described = shared.value
        types = {"train_fraction": pa.float64(), "model_number": pa.int32(), "numIter": pa.int32()}
        types |= {"stepSize": pa.float64(), "regParam": pa.float64()}
        described = {name: pa.array(values, types.get(name, pa.string())) for name, values in described.items()}
        known = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            labels = batch.column("label").dictionary_encode()
            codes = labels.indices.to_numpy()
            buckets = batch.column("bucket").to_numpy()
            vectors = matrix_of(batch.column("features"), weights.shape[1])
            carried = [batch.column(name) for name in carry]
            for code, label in enumerate(labels.dictionary.to_pylist()):
                if label not in known:
                    known[label] = members(membership, label)
                for cut, numbers, indices in known[label]:
                    rows = np.flatnonzero((codes == code) & (buckets >= cut))
                    if not len(rows) or not len(numbers):
                        continue
                    width = max(1, 500_000 // len(numbers))
                    for start in range(0, len(rows), width):
                        part = rows[start:start + width]
                        predicted = vectors[part] @ weights[numbers].T > 0
                        actual = np.broadcast_to(indices, predicted.shape)
                        keep = predicted != actual if errors_only else np.ones(predicted.shape, dtype=bool)
                        at_row, at_model = np.nonzero(keep)
                        if not len(at_row):
                            continue
                        taken, of_model = pa.array(part[at_row]), pa.array(numbers[at_model])
                        yield pa.RecordBatch.from_arrays(
                            [
                                *[column.take(of_model) for column in described.values()],
                                pa.array(actual[keep].astype(float)),
                                pa.array(predicted[keep].astype("i4")),
                                *[column.take(taken) for column in carried],
                            ],
                            names=[*described, "label_index", "label_index_predicted", *carry],
                        )

    return predict_rows
