import json

import pytest

from pairclf.operators.selection import best_models
from pairclf.sources.count_lines import read_count_lines, write_total_lines
from pairclf.sources.feature_files import (
    feature_rows,
    parse_feature_records,
    read_feature_files,
    read_rejects,
    scan_feature_files,
    two_sources,
    write_feature_files,
)
from pairclf.sources.result_files import (
    write_best_models,
    write_best_models_object,
    write_curve,
    write_report,
)

METRIC = (
    "kind string, class1 string, class2 string, train_fraction double, model_number int, numIter int, "
    "stepSize double, regParam double, eval_set string, hits bigint, errors bigint, total bigint, "
    "accuracy double, error_rate double"
)


def metric(class1, class2, number, limit, hits, total, fraction=0.5, eval_set="test"):
    accuracy = hits / total if total else None
    return ("1vs1", class1, class2, fraction, number, limit, 1.0, 0.01, eval_set, hits, total - hits, total,
            accuracy, None if accuracy is None else 1 - accuracy)


@pytest.fixture
def folder(tmp_path):
    contents = {"cat_1.jpg.json": "[1.0,2.0]", "dog_2.jpg.json": "9,9\n[3.0,4.0]\n", "cow_3.jpg.json": "", "ox_4.jpg.json": " \n"}
    for name, text in contents.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "inner").mkdir()
    (tmp_path / "inner" / "cat_9.jpg.json").write_text("[7,7]")
    return str(tmp_path)


def test_feature_files(spark, folder):
    rows = {tuple(r["features"]): (r["label"], r["images"]) for r in read_feature_files(spark, folder).collect()}
    assert rows == {(1.0, 2.0): ("cat", "cat_1.jpg.json"), (3.0, 4.0): ("dog", "dog_2.jpg.json")}
    rejects = sorted(tuple(r) for r in read_rejects(spark, folder).collect())
    assert rejects == [("cow_3.jpg.json", "empty file"), ("ox_4.jpg.json", "empty file")]


def test_strict_scan_raises(spark, folder):
    with pytest.raises(ValueError, match="empty feature file: cow_3.jpg.json"):
        read_feature_files(spark, folder, strict=True)
    with pytest.raises(Exception, match="empty feature file: ox_4.jpg.json"):
        parse_feature_records(scan_feature_files(spark, folder), strict=True).collect()


def test_written_files_read_back(spark, tmp_path):
    records = spark.createDataFrame(
        [(f"pug_{i}.jpg.json", f"[{i}.0, 0.5]") for i in range(20)], "images string, value string"
    )
    assert write_feature_files(records, str(tmp_path / "files")) == 20
    read = read_feature_files(spark, str(tmp_path / "files"))
    assert sorted(r["features"][0] for r in read.collect()) == [float(i) for i in range(20)]
    assert read.select("label").distinct().collect()[0][0] == "pug"


def test_two_sources_keep_duplicates(spark):
    frame = feature_rows(spark, [("a", [1.0], "a_1.jpg.json")])
    both = two_sources(frame, frame)
    assert sorted(r["source"] for r in both.collect()) == ["all", "main"]


def text_of(spark, path):
    import glob

    return "".join(open(p).read() for p in sorted(glob.glob(f"{path}/part-*")))


def test_best_models_as_json(spark, tmp_path):
    rows = [metric("a", c, 1, 10, 3, 4) for c in ("b", 'q"uote', "z")] + [metric("b", "z", 1, 10, 0, 4)]
    best = best_models(spark.createDataFrame(rows, METRIC)).repartition(3)
    write_best_models_object(best, str(tmp_path / "object"))
    found = json.loads(text_of(spark, tmp_path / "object"))
    record = {"Accuracy": 0.75, "numIter": 10, "stepSize": 1.0, "regParam": 0.01}
    nothing = {"Accuracy": 0.0, "numIter": None, "stepSize": None, "regParam": None}
    assert found == {"a_vs._b": record, 'a_vs._q"uote': record, "a_vs._z": record, "b_vs._z": nothing}
    write_best_models(best, str(tmp_path / "lines"))
    lines = [json.loads(line) for line in text_of(spark, tmp_path / "lines").splitlines()]
    assert {line["task"] for line in lines} == set(found)


def test_curve_report_and_word_files(spark, tmp_path):
    curve = spark.createDataFrame([("a_vs._b", 0.2, 0.5)], "task string, train_fraction double, accuracy double")
    write_curve(curve, str(tmp_path / "curve"))
    write_curve(curve.coalesce(1), str(tmp_path / "csv"), "csv")
    assert spark.read.parquet(str(tmp_path / "curve")).collect() == curve.collect()
    assert text_of(spark, tmp_path / "csv") == "task,train_fraction,accuracy\na_vs._b,0.2,0.5\n"
    write_report(spark.createDataFrame([("|x\n|y",)], "report string"), str(tmp_path / "report"))
    assert text_of(spark, tmp_path / "report") == "|x\n|y\n"
    (tmp_path / "in.txt").write_text("a 1\na 2\nb 1\n")
    from pairclf.operators.words import word_totals

    totals = word_totals(read_count_lines(spark, str(tmp_path / "in.txt"))).orderBy("word").coalesce(1)
    write_total_lines(totals, str(tmp_path / "words"))
    assert text_of(spark, tmp_path / "words") == "a\t3 occurences\nb\t1 occurences\n"


def test_names_of_every_kind_come_back_as_they_are(spark, tmp_path):
    names = ["_x_1.jpg.json", ".y_2.jpg.json", "great dane_3.jpg.json", "a%20b_4.jpg.json", "a+b_5.jpg.json", "é_6.jpg.json"]
    for name in names:
        (tmp_path / name).write_text("[1.0,2.0]")
    (tmp_path / "_empty_1.jpg.json").write_text("")
    rows = {r["images"]: r["label"] for r in read_feature_files(spark, str(tmp_path)).collect()}
    assert rows == dict(zip(names, ["x", ".y", "great dane", "a%b", "a+b", "é"]))
    assert [r["images"] for r in read_rejects(spark, str(tmp_path)).collect()] == ["_empty_1.jpg.json"]


def test_listing_of_many_names_is_dealt_and_streamed(spark, tmp_path):
    import tracemalloc

    import pyarrow as pa

    from pairclf.sources import feature_files as ff

    for number in range(50_000):
        (tmp_path / f"{'_' if number % 1000 == 0 else ''}some_longer_class_name_{number}.jpg.json").touch()
    (tmp_path / "_full_7.jpg.json").write_text("[1.0,2.0]")
    (tmp_path / "folder").mkdir()
    listed = ff.list_files(spark, str(tmp_path))
    assert listed.count() == listed.distinct().count() == 50_001
    assert listed.rdd.getNumPartitions() == 8
    assert ff.empty_files(spark, str(tmp_path)).count() == 50_000
    assert [tuple(r) for r in ff._hidden_files(spark, str(tmp_path)).collect()] == [("_full_7.jpg.json", "[1.0,2.0]")]
    # What one task holds does not grow with the directory.
    slices = [pa.RecordBatch.from_pydict({"id": [0], "slices": [8]})]
    entries = ff._entries()
    tracemalloc.start()
    sizes = [len(names) for names, _ in entries(str(tmp_path), slices)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 5000 < sum(sizes) < 7500 and max(sizes) == 1000 and peak < 1_000_000
