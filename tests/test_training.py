import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairclf.operators.blocks import pack_blocks, vector_size
from pairclf.operators.classes import Grid, relabel_rest, task_table
from pairclf.operators import svm
from pairclf.operators.scoring import evaluate, predict, prediction_metrics, right, second_source_rows, wrong
from pairclf.operators.splits import bucket_counts, label_index, task_label_counts, trainable_tasks, with_bucket
from pairclf.operators.svm import model_weights, train
from pairclf.plans.tournament import run_tournament
from pairclf.sources.feature_files import feature_rows

from brute import bucket, descend, label_order, side_of

GRID = Grid([1, 10, 30])


@pytest.fixture(scope="module")
def cache():
    return {}


@pytest.fixture
def trained(points, cache):
    if not cache:
        tasks = task_table(points, [50], [50, 80])
        indexed = label_index(task_label_counts(bucket_counts(with_bucket(points)), tasks))
        blocks = pack_blocks(points, 5, 80)
        runnable = trainable_tasks(indexed).cache()
        cache.update(points=points, tasks=runnable, blocks=blocks, models=train(blocks, runnable, 5, GRID).cache())
    return cache


def weights_of(models):
    keys = ("kind", "class1", "class2", "train_fraction", "numIter", "stepSize", "regParam")
    return {tuple(r[k] for k in keys): np.array(r["weights"]) for r in models.collect()}


def test_weights_equal_plain_descent(trained):
    rows = [tuple(r) for r in trained["points"].collect()]
    for model in trained["models"].collect():
        w, run = descend(rows, model, model["cut"], model["numIter"])
        assert np.allclose(model["weights"], w, atol=1e-10)
        assert model["iterations_run"] == run
        assert model["class1_index"] == label_order(rows, model, model["cut"]).index(model["class1"])


def test_early_stop_equals_plain_descent(trained):
    rows = [tuple(r) for r in trained["points"].collect()]
    models = train(trained["blocks"], trained["tasks"], 5, Grid([60]), tolerance=0.05).collect()
    assert min(m["iterations_run"] for m in models) < max(m["iterations_run"] for m in models)
    for model in models:
        w, run = descend(rows, model, model["cut"], 60, tolerance=0.05)
        assert np.allclose(model["weights"], w, atol=1e-10) and model["iterations_run"] == run


def test_training_in_chunks_gives_the_same_models(trained):
    whole = weights_of(trained["models"])
    many = pack_blocks(trained["points"].repartition(6), 5, 80)
    small = train(many, trained["tasks"], 5, GRID, chunk_bytes=2000)
    assert small.select("model_id").distinct().count() == len(whole)
    for key, w in weights_of(small).items():
        assert np.allclose(w, whole[key], atol=1e-10)


def test_reruns_give_the_same_bits(trained):
    again = train(trained["blocks"], trained["tasks"].filter("kind = '1vs1'"), 5, Grid([20]))
    more = train(trained["blocks"], trained["tasks"].filter("kind = '1vs1'"), 5, Grid([20]))
    first, second = weights_of(again), weights_of(more)
    assert first.keys() == second.keys() and all((first[k] == second[k]).all() for k in first)


def test_sums_in_the_driver_and_in_tasks_are_the_same_bits(trained, monkeypatch):
    blocks = pack_blocks(trained["points"].repartition(6), 5, 80)
    tasks = trained["tasks"].filter("train_fraction = 0.5")
    gathered = weights_of(train(blocks, tasks, 5, Grid([4, 15])))
    for most in (1, 1500):
        monkeypatch.setattr(svm, "GATHERED_BYTES", most)
        shuffled = weights_of(train(blocks, tasks, 5, Grid([4, 15])))
        assert gathered.keys() == shuffled.keys() and all((gathered[k] == shuffled[k]).all() for k in gathered)


def test_many_small_partitions_make_few_sums(spark, monkeypatch):
    from pairclf.operators import blocks

    rows = spark.range(0, 1000, 1, 200)
    assert blocks.in_larger_parts(rows, 1000, 10).rdd.getNumPartitions() == 8
    monkeypatch.setattr(blocks, "PART_BYTES", 10)
    assert blocks.in_larger_parts(rows, 1000, 0).rdd.getNumPartitions() == 100
    assert blocks.in_larger_parts(rows, 1000, 1).rdd.getNumPartitions() == 63
    assert blocks.in_larger_parts(rows, 10_000, 1).rdd.getNumPartitions() == 200


def test_blocks_part_at_the_largest_cut_and_by_label(trained):
    for block in trained["blocks"].collect():
        buckets = np.frombuffer(block["buckets"], dtype="u1")
        assert block["min_bucket"] == buckets[0] and (np.diff(buckets.astype(int)) >= 0).all()
        assert (buckets < 80).all() or (buckets >= 80).all()
    # Labels are gathered over Arrow batches: one train and one test block for each.
    one = pack_blocks(trained["points"].coalesce(1), 5, 80)
    assert one.count() == 8


def test_a_pass_reads_only_the_train_blocks_of_its_labels(trained, monkeypatch):
    seen = []
    original = svm._passes

    class Spy:
        def __init__(self, blocks):
            self.blocks, self.sparkSession = blocks, blocks.sparkSession

        def filter(self, condition):
            return Spy(self.blocks.filter(condition))

        def mapInArrow(self, *arguments):
            seen.extend((r["label"], r["min_bucket"]) for r in self.blocks.select("label", "min_bucket").collect())
            return self.blocks.mapInArrow(*arguments)

    monkeypatch.setattr(svm, "_passes", lambda blocks, *rest: original(Spy(blocks), *rest))
    train(trained["blocks"], trained["tasks"].filter("kind = '1vs1' and class1 = 'a' and class2 = 'c'"), 5, Grid([3]))
    assert {label for label, _ in seen} == {"a", "c"} and max(bucket for _, bucket in seen) < 50 + 30


def test_iterations_leave_no_broadcast_files(spark, trained):
    folder = spark.sparkContext._temp_dir
    count = lambda: sum(len(files) for _, _, files in os.walk(folder))
    tasks = trained["tasks"].filter("kind = '1vs1'")
    train(trained["blocks"], tasks, 5, Grid([2]))
    before = count()
    models = train(trained["blocks"], tasks, 5, Grid([40]), chunk_bytes=2000)
    predict(trained["points"], models, chunk_bytes=200)
    evaluate(trained["blocks"], models, chunk_bytes=200)
    assert count() - before <= 3


def test_weights_equal_the_library_trainer(spark, trained):
    from pyspark.mllib.classification import LabeledPoint, SVMWithSGD

    for kind, class1, class2, cut in (("1vs1", "a", "d", 50), ("1vsAll", "b", "All", 80)):
        frame = with_bucket(trained["points"]).filter(F.col("bucket") < cut)
        frame = frame.filter(F.col("label").isin(class1, class2)) if kind == "1vs1" else relabel_rest(frame, class1)
        task = {"kind": kind, "class1": class1, "class2": class2}
        order = label_order([tuple(r) for r in trained["points"].collect()], task, cut)
        data = frame.rdd.map(lambda r: LabeledPoint(float(order.index(r["label"])), r["features"])).cache()
        for limit in (10, 30):
            library = SVMWithSGD.train(data, limit, 1.0, regParam=0.01)
            ours = weights_of(trained["models"])[kind, class1, class2, cut / 100, limit, 1.0, 0.01]
            assert np.allclose(ours, library.weights.toArray(), atol=1e-9)
            vectors = [r["features"] for r in trained["points"].collect()]
            assert [int(np.dot(v, ours) > 0) for v in vectors] == [library.predict(v) for v in vectors]


def test_grid_of_steps_and_regularisation(trained):
    rows = [tuple(r) for r in trained["points"].collect()]
    grid = Grid([5, 20], [0.5, 1.0], [0.01, 0.1])
    pairs = trained["tasks"].filter("kind = '1vs1'")
    models = train(trained["blocks"], pairs, 5, grid).collect()
    assert len(models) == 6 * 8
    for model in models:
        w, _ = descend(rows, model, 50, model["numIter"], model["stepSize"], model["regParam"])
        assert np.allclose(model["weights"], w, atol=1e-10)
        expected = grid.numbers()[model["numIter"], model["stepSize"], model["regParam"]]
        assert model["model_number"] == expected


def test_predictions_and_counts_agree_with_brute_force(trained):
    rows = [tuple(r) for r in trained["points"].collect()]
    expected = {}
    for model in trained["models"].collect():
        order = label_order(rows, model, model["cut"])
        for label, x, image in rows:
            side = side_of(model, label)
            if side is not None and bucket(image) >= model["cut"]:
                key = model["kind"], model["class1"], model["class2"], model["train_fraction"], model["numIter"], image
                expected[key] = (float(order.index(side)), int(np.dot(x, model["weights"]) > 0))
    predictions = predict(trained["points"], trained["models"], chunk_bytes=200).cache()
    got = {
        (r["kind"], r["class1"], r["class2"], r["train_fraction"], r["numIter"], r["images"]):
            (r["label_index"], r["label_index_predicted"])
        for r in predictions.collect()
    }
    assert got == expected
    errors = predict(trained["points"], trained["models"], errors_only=True)
    assert errors.count() == wrong(predictions).count() == predictions.count() - right(predictions).count()
    keys = ["kind", "class1", "class2", "train_fraction", "numIter"]
    columns = [*keys, "hits", "errors", "total", "accuracy", "error_rate"]
    one = prediction_metrics(predictions, keys).select(columns)
    for chunk_bytes in (200, 10_000_000):
        two = evaluate(trained["blocks"], trained["models"], chunk_bytes=chunk_bytes).select(columns)
        assert {tuple(r) for r in one.collect()} == {tuple(r) for r in two.collect()}


def test_second_source_scores_its_own_names_from_its_own_share_on(spark, trained):
    rows = [tuple(r) for r in trained["points"].collect()]
    own = [(label, x, f"{label}_{i}_2.jpg.json") for i, (label, x, _) in enumerate(rows)]
    second = feature_rows(spark, rows[:100] + own)
    scored = second_source_rows(second, trained["points"], 50, 80)
    rest = trained["models"].filter("kind = '1vsAll' and numIter = 10")
    totals = {
        (r["class1"], r["train_fraction"]): r["total"] for r in evaluate(pack_blocks(scored, 5, 80), rest, "all").collect()
    }
    for cut in (50, 80):
        known = sum(bucket(image) >= cut for _, _, image in rows[:100])
        assert totals["a", cut / 100] == known + sum(bucket(image) >= 50 for _, _, image in own)


def test_uneven_and_null_vectors_raise_when_scored(spark, trained):
    for bad in ([1.0], [1.0, None, 1.0, 1.0, 1.0], None):
        frame = feature_rows(spark, [("a", [1.0] * 5, f"a_{i}.jpg.json") for i in range(8)] + [("a", bad, "a_9.jpg.json")])
        with pytest.raises(Exception, match="numbers expected|holds a null"):
            predict(frame, trained["models"]).collect()


def test_no_test_rows_means_null_accuracy(spark):
    names = [f"{c}_{i}.jpg.json" for c in "ab" for i in range(60) if bucket(f"{c}_{i}.jpg.json") < 90]
    frame = feature_rows(spark, [(n[0], [1.0, 2.0 if n[0] == "a" else -2.0], n) for n in names])
    run = run_tournament(frame, pair_percents=[90], rest_percents=[], grid=Grid([3]))
    metric = run.metrics.collect()[0]
    assert (metric["total"], metric["accuracy"], metric["error_rate"]) == (0, None, None)


def test_one_hot_class_and_uneven_vectors(spark):
    names = [("a", i) for i in range(400)] + [("b", i) for i in range(5)] + [("c", i) for i in range(5)]
    frame = feature_rows(spark, [(c, [float(ord(c) - 98), 1.0], f"{c}_{i}.jpg.json") for c, i in names])
    run = run_tournament(frame, grid=Grid([5]))
    rows = [tuple(r) for r in frame.collect()]
    for model in run.models.collect():
        assert np.allclose(model["weights"], descend(rows, model, model["cut"], 5)[0], atol=1e-10)
    uneven = feature_rows(spark, [("a", [1.0], "a_1"), ("a", [1.0, 2.0], "a_2")])
    with pytest.raises(Exception, match="numbers expected"):
        pack_blocks(uneven, 1).count()
    assert vector_size(frame) == 2


def test_model_weights_are_long_form(trained):
    rows = model_weights(trained["models"]).filter("numIter = 10 and class1 = 'a' and class2 = 'b'").orderBy("k").collect()
    assert [r["k"] for r in rows] == [1, 2, 3, 4, 5]
