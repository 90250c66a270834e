import random

import pytest
from pyspark.sql import functions as F

from pairclf.operators.classes import Grid, class_list, class_pairs, filter_pair, grid_points, relabel_rest, task_table
from pairclf.operators.images import pair_image_index, rest_image_index
from pairclf.operators.indexing import apply_index, number_in_order, string_index
from pairclf.operators.splits import (
    bucket_counts,
    label_index,
    random_split,
    split_counts,
    task_label_counts,
    trainable_tasks,
    untrainable_tasks,
    with_bucket,
)
from pairclf.sources.feature_files import feature_rows

from brute import bucket, label_order, side_of


def test_classes_and_pairs(points):
    assert [r[0] for r in class_list(points).collect()] == ["a", "b", "c", "d"]
    pairs = sorted(tuple(r) for r in class_pairs(points).collect())
    assert pairs == [(x, y) for x in "abcd" for y in "abcd" if x < y]


def test_one_class_has_no_pair(spark):
    assert class_pairs(feature_rows(spark, [("a", [1.0], "a_1")])).collect() == []


def test_pairs_need_no_cross_join(points):
    plan = class_pairs(points)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_pair_filter_and_relabel(points):
    assert {r["label"] for r in filter_pair(points, "a", "c").collect()} == {"a", "c"}
    relabelled = relabel_rest(points, "b")
    assert relabelled.count() == points.count()
    assert {r["label"] for r in relabelled.collect()} == {"b", "All"}


def test_grid_is_numbered_iterations_first(points):
    grid = Grid([10, 50], [1.0, 2.0], [0.01, 0.1])
    task = task_table(points, [50]).filter("task = 'a_vs._b'")
    got = [tuple(r)[-4:] for r in grid_points(task, grid).orderBy("model_number").collect()]
    expected = [(i, s, r) for i in (10, 50) for s in (1.0, 2.0) for r in (0.01, 0.1)]
    assert got == [(n + 1, *point) for n, point in enumerate(expected)]


def test_split_sizes_and_label_index(points):
    rows = [tuple(r) for r in points.collect()]
    tasks = task_table(points, [20, 50], [0, 80])
    counts = task_label_counts(bucket_counts(with_bucket(points)), tasks)
    sizes = {(r["class1"], r["class2"], r["train_fraction"], r["is_test"]): r["n"] for r in split_counts(counts).collect()}
    indices = {}
    for r in label_index(counts).collect():
        indices[r["class1"], r["class2"], r["cut"], r["task_label"]] = r["label_index"]
    for task in tasks.collect():
        inside = [bucket(image) for label, _, image in rows if side_of(task, label) is not None]
        key = task["class1"], task["class2"], task["train_fraction"]
        assert sizes[*key, False] == sum(b < task["cut"] for b in inside)
        assert sizes[*key, True] == sum(b >= task["cut"] for b in inside)
        for place, side in enumerate(label_order(rows, task, task["cut"])):
            assert indices[task["class1"], task["class2"], task["cut"], side] == place


def test_task_with_one_training_label_is_reported(spark):
    train = [f"a_{i}.jpg.json" for i in range(300) if bucket(f"a_{i}.jpg.json") < 50][:3]
    test = [f"b_{i}.jpg.json" for i in range(300) if bucket(f"b_{i}.jpg.json") >= 50][:3]
    frame = feature_rows(spark, [("a", [1.0], n) for n in train] + [("b", [1.0], n) for n in test])
    counts = task_label_counts(bucket_counts(with_bucket(frame)), task_table(frame, [50]))
    assert trainable_tasks(label_index(counts)).collect() == []
    assert [tuple(r)[1:3] for r in untrainable_tasks(counts).collect()] == [("a", "b")]


def test_random_split_is_seeded(points):
    train, test = random_split(points, 50, seed=3)
    again, _ = random_split(points, 50, seed=3)
    assert train.count() + test.count() == 240
    assert sorted(r["images"] for r in train.collect()) == sorted(r["images"] for r in again.collect())


def test_string_index_sample(spark):
    frame = spark.createDataFrame(list(enumerate("abcaac")), "id int, category string")
    index = string_index(frame, "category", "categoryIndex")
    got = {r["category"]: r["categoryIndex"] for r in apply_index(frame, index, "category", "categoryIndex").collect()}
    assert got == {"a": 0.0, "c": 1.0, "b": 2.0}
    tie = spark.createDataFrame([(c,) for c in "bacc"], "category string")
    assert {tuple(r) for r in string_index(tie, "category", "i").collect()} == {("c", 0.0), ("a", 1.0), ("b", 2.0)}
    with pytest.raises(Exception, match="unseen value: z"):
        apply_index(spark.createDataFrame([("z",)], "category string"), index, "category", "categoryIndex").collect()


def test_string_index_equals_the_built_in_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    frame = spark.range(3000).select((F.pow(F.col("id") % 97, 2) % 41).cast("int").cast("string").alias("v"))
    built_in = StringIndexer(inputCol="v", outputCol="i").fit(frame).transform(frame).distinct()
    ours = string_index(frame.repartition(7), "v", "i")
    assert {tuple(r) for r in ours.collect()} == {tuple(r) for r in built_in.select("v", "i").collect()}


def test_numbering_over_many_partitions_and_keys(spark):
    frame = spark.range(5000).select((F.col("id") % 3).alias("k"), F.hash("id").alias("v"), "id").repartition(6)
    got = {(r["k"], r["id"]): r["number"] for r in number_in_order(frame, ["k"], [F.col("v"), F.col("id")]).collect()}
    rows = sorted((r["k"], r["v"], r["id"]) for r in frame.collect())
    expected, seen = {}, {}
    for k, _, i in rows:
        expected[k, i] = seen.get(k, 0)
        seen[k] = expected[k, i] + 1
    assert got == expected


def test_numbering_with_hot_null_and_nan_keys(spark):
    nan = float("nan")
    rows = [("hot", 1.0, i) for i in range(900)] + [(None, 1.0, i) for i in range(40)] + [("x", nan, i) for i in range(30)]
    rows += [("x", 2.0, 7), ("y", None, 1), ("y", None, 2)]
    random.Random(4).shuffle(rows)
    frame = spark.createDataFrame(rows, "k string, f double, id int").repartition(9)
    numbered = number_in_order(frame, ["k", "f"], [F.col("id").desc()])
    got = sorted(map(repr, (tuple(r) for r in numbered.collect())))
    groups = {}
    for k, f, i in rows:
        groups.setdefault((k, repr(f)), []).append((k, f, i))
    want = [(*row, n) for g in groups.values() for n, row in enumerate(sorted(g, key=lambda r: -r[2]))]
    assert got == sorted(map(repr, want))
    # Rows are not joined on their key; one row per partition is broadcast.
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "_part" in plan[plan.index("Join"):].splitlines()[0]


def test_pairs_put_no_catalogue_into_one_task(points):
    plan = class_pairs(points)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_many_classes_pair_once(spark):
    names = [f"class {i}" for i in range(60)]
    frame = spark.createDataFrame([(n,) for n in names] + [(None,)], "label string")
    pairs = [tuple(r) for r in class_pairs(frame).collect()]
    assert len(pairs) == len(set(pairs)) == 60 * 59 // 2 and all(a < b for a, b in pairs)


def test_image_index(points):
    tasks = task_table(points, [50])
    rows = pair_image_index(points, tasks).filter("class1 = 'a' and class2 = 'b'").orderBy("images_index").collect()
    names = sorted(r["images"] for r in points.collect() if r["label"] in "ab" and bucket(r["images"]) >= 50)
    assert [r["images"] for r in rows] == names and [r["images_index"] for r in rows] == list(range(len(names)))
    rest = rest_image_index(points, [80, 90]).filter("train_fraction = 0.8").orderBy("images_index").collect()
    assert [r["images"] for r in rest] == sorted(r["images"] for r in points.collect() if bucket(r["images"]) >= 80)
