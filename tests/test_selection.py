import numpy as np
import pytest
from pyspark.sql import functions as F

from pairclf.operators.misclassified import first_images, misclassified, misclassified_by_vector
from pairclf.operators.selection import (
    best_model_reports,
    best_models,
    fraction_curve,
    iteration_curve,
    last_fraction,
    model_reports,
)
from pairclf.operators.classes import Grid
from pairclf.plans.tournament import run_tournament
from pairclf.sources.feature_files import feature_rows

from brute import bucket, label_order
from test_sources import METRIC, metric

LIMITS = (10, 50, 100, 300)


def frame(spark, *rows):
    return spark.createDataFrame(rows, METRIC)


def grid(c, hits, fraction=0.5):
    return [metric("a", c, n + 1, limit, h, 10, fraction) for n, (limit, h) in enumerate(zip(LIMITS, hits))]


def test_best_model_ties_go_to_the_first(spark):
    metrics = frame(spark, *grid("b", (5, 7, 7, 6)), *grid("c", (9, 9, 9, 9)), *grid("d", (0, 0, 0, 0)),
                    metric("a", "b", 4, 300, 10, 10, eval_set="all"))
    best = {r["task"]: (r["numIter"], r["model_number"], r["accuracy"]) for r in best_models(metrics).collect()}
    assert best == {"a_vs._b": (50, 2, 0.7), "a_vs._c": (10, 1, 0.9), "a_vs._d": (None, None, 0.0)}


def test_last_fraction_and_curves(spark):
    metrics = frame(spark, *grid("b", (5, 7, 7, 6), 0.2), *grid("b", (1, 2, 3, 4), 0.9))
    best = best_models(metrics)
    assert [r["accuracy"] for r in last_fraction(best).collect()] == [0.4]
    curve = sorted((r["train_fraction"], r["accuracy"]) for r in fraction_curve(best).collect())
    assert curve == [(0.2, 0.7), (0.9, 0.4)]
    series = iteration_curve(metrics).filter("train_fraction = 0.9").orderBy("numIter").collect()
    assert [(r["numIter"], r["accuracy"]) for r in series] == [(10, 0.1), (50, 0.2), (100, 0.3), (300, 0.4)]
    assert series[0]["curve"] == "0.9_Obs_a_vs_b.png"


def test_reports(spark):
    metrics = frame(spark, metric("a", "b", 2, 50, 3, 4), metric("a", "b", 2, 50, 1, 4, eval_set="all"))
    reports = {r["eval_set"]: r["report"] for r in model_reports(metrics).collect()}
    assert reports["test"] == (
        "|Model #2\n"
        "|Model trained with (numIter: 50.00, stepSize = 1.00, regParam = 0.01)\n"
        "|Model has accuracy of 0.750 (errors: 1 / training error: 0.250) on test"
    )
    assert reports["all"].startswith("|Model_All #2\n|Model_All trained with")
    assert best_model_reports(best_models(metrics)).first()["report"] == (
        "|Model #2 is the best model\n"
        "|The best model was trained with (numIter: 50.00, stepSize = 1.00, regParam = 0.01)\n"
        "|The best model has accuracy of 0.750 (errors: 1 / training error: 0.250) on test"
    )


def plain_chain(rows, errors):
    """How often the chain of joins lists an image: on the vector, then on the name."""
    times = {}
    for _, wrong_vector in errors:
        for _, vector, image in rows:
            if vector == wrong_vector:
                for _, _, other in rows:
                    if other == image:
                        times[image] = times.get(image, 0) + 1
    return times


def weak_hash(column):
    return F.size(column) % 2


@pytest.mark.parametrize("hash_of", [F.xxhash64, weak_hash])
def test_copies_of_an_image_are_listed_once(spark, hash_of):
    # Vectors that no model without intercept can tell apart, with copies of rows
    # and of vectors, and one name with two vectors.
    rows = [("a", [9.0, 1.0], "a_1.jpg.json"), ("a", [-9.0, 1.0], "a_3.jpg.json")]
    for c in "ab":
        for i in range(40):
            vector = [float(i % 4) - 1.5, 1.0]
            rows += [(c, vector, f"{c}_{i}.jpg.json")] * (2 if i % 5 == 0 else 1)
    features = feature_rows(spark, rows).repartition(3)
    run = run_tournament(features, rest_percents=[], grid=Grid([7]))
    errors = [(r["images"],) for r in misclassified(features, run.models).collect()]
    assert errors
    test_rows = [row for row in rows if bucket(row[2]) >= 50]
    order = label_order(rows, {"kind": "1vs1", "class1": "a", "class2": "b"}, 50)
    weights = run.models.first()["weights"]
    wrong_rows = [
        (image, vector) for label, vector, image in test_rows
        if int(np.dot(vector, weights) > 0) != order.index(label)
    ]
    assert sorted(image for image, _ in wrong_rows) == sorted(image for (image,) in errors)
    expected = plain_chain(test_rows, wrong_rows)
    listed = misclassified_by_vector(features, run.models, hash_of).collect()
    assert len({r["images"] for r in listed}) == len(listed)
    assert {r["images"]: r["times_listed"] for r in listed} == expected
    assert {image for (image,) in errors} <= set(expected)


def test_image_present_twice_counts_eight_times(spark):
    train = [n for n in (f"{c}_{i}.jpg.json" for c in "ab" for i in range(90)) if bucket(n) < 50]
    test = next(n for n in (f"a_{i}.jpg.json" for i in range(90)) if bucket(n) >= 50)
    rows = [(n[0], [1.0 if n[0] == "a" else -1.0, 0.0], n) for n in train]
    features = feature_rows(spark, [*rows, *[("a", [-5.0, 0.0], test)] * 2])
    run = run_tournament(features, rest_percents=[], grid=Grid([10]))
    assert misclassified(features, run.models).count() == 2
    assert [(r["images"], r["times_listed"]) for r in misclassified_by_vector(features, run.models).collect()] == [(test, 8)]


def test_first_thirty_by_name(spark):
    errors = spark.range(200).select(
        F.lit("1vs1").alias("kind"), F.when(F.col("id") < 100, "a").otherwise("c").alias("class1"), F.lit("b").alias("class2"),
        F.lit(0.5).alias("train_fraction"), F.lit(10).alias("numIter"), F.lit(1.0).alias("stepSize"),
        F.lit(0.01).alias("regParam"), F.format_string("a_%03d", "id").alias("images"),
    )
    names = sorted(r["images non reconnus"] for r in first_images(errors).collect())
    assert names == [f"a_{i:03d}" for first in (0, 100) for i in range(first, first + 30)]
    assert "WindowGroupLimit" in first_images(errors)._jdf.queryExecution().toString()


def test_a_vector_with_many_images_is_cut_before_models_see_it(spark, monkeypatch):
    from pairclf.operators import misclassified as mc

    # One vector in 100 000 rows of two labels, wrong for at least one of them, and few others.
    label = F.when(F.col("id") % 3 == 0, "a").otherwise("b")
    hot = spark.range(100_000).select(label.alias("label"), F.array(F.lit(1.0), F.lit(0.5)).alias("features"),
                                      F.concat(label, F.lit("_"), F.col("id").cast("string"), F.lit(".jpg.json")).alias("images"))
    rest = [(c, [s * (i % 7), s * 2.0], f"{c}_x{i}.jpg.json") for c, s in (("a", 1.0), ("b", -1.0), ("c", -2.0)) for i in range(40)]
    features = hot.unionByName(feature_rows(spark, rest)).repartition(6)
    run = run_tournament(features, rest_percents=[80], grid=Grid([2]))
    sizes = []
    real = mc._images_with_vector

    def watched(*arguments):
        names = real(*arguments)
        sizes.append(names.count())
        return names

    monkeypatch.setattr(mc, "_images_with_vector", watched)
    cut = misclassified_by_vector(features, run.models, listed=30)
    got = sorted(tuple(r) for r in cut.select("kind", "class1", "class2", "images", "times_listed").collect())
    whole = misclassified_by_vector(features, run.models).withColumnRenamed("times_listed", "times")
    first = first_images(whole, ("times",)).select("kind", "class1", "class2", "images non reconnus", "times")
    assert got == sorted(tuple(r) for r in first.collect()) and len(got) >= 60
    models, vectors = run.models.count(), 1 + 7 * 3
    assert sizes[0] <= 30 * 2 * models * vectors < sizes[1]


def test_listed_names_may_have_several_labels_and_vectors(spark):
    rows = [(c, [float(i % 4) - 1.5, 1.0], f"n_{i % 30}.jpg.json") for i in range(240) for c in ("a", "b")]
    features = feature_rows(spark, rows).repartition(4)
    run = run_tournament(features, rest_percents=[50], grid=Grid([3]))
    cut = misclassified_by_vector(features, run.models, weak_hash, listed=4).collect()
    whole = misclassified_by_vector(features, run.models).withColumnRenamed("times_listed", "times")
    first = first_images(whole, ("times",), 4).select("kind", "class1", "class2", "images non reconnus", "times").collect()
    assert cut and sorted((r["kind"], r["class1"], r["class2"], r["images"], r["times_listed"]) for r in cut) == sorted(map(tuple, first))
