import glob
import json
from types import SimpleNamespace

import pytest

from pairclf.__main__ import main
from pairclf.operators.classes import Grid
from pairclf.plans.programs import classify
from pairclf import session
from pairclf.session import shared_dir


def folder(path, shift, count=40):
    path.mkdir()
    for label, center in (("cat", 2.0), ("dog", -2.0), ("great_dane", 0.5)):
        for i in range(count):
            values = [center + shift + (i % 7) / 3, (i % 5) - 2.0, 1.0]
            (path / f"{label}_{i}.jpg.json").write_text(str(values))
    return str(path)


@pytest.mark.parametrize("sweep", [False, True])
def test_classify_writes_every_result(spark, tmp_path, sweep):
    main_dir, second_dir = folder(tmp_path / "main", 0.0), folder(tmp_path / "all", 0.1)
    out = str(tmp_path / "out")
    run = classify(spark, main_dir, second_dir, out, sweep=sweep, grid=Grid([3, 8]))
    text = "".join(open(p).read() for p in sorted(glob.glob(f"{out}/best_classifiers/part-*")))
    best = json.loads(text)
    tasks = {"cat_vs._dog", "cat_vs._great_dane", "dog_vs._great_dane", "cat_vs._All", "dog_vs._All", "great_dane_vs._All"}
    assert set(best) == tasks
    assert best["cat_vs._dog"]["Accuracy"] > 0.9
    shares = 4 if sweep else 1
    assert run.metrics.count() == shares * 2 * (3 + 3 * 2)
    assert spark.read.parquet(f"{out}/curve_fraction").count() == shares * 6
    assert spark.read.parquet(f"{out}/rejects").count() == 0
    assert "has accuracy of" in open(glob.glob(f"{out}/model_report/part-*")[0]).read()


def test_words_command(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("b 2\na 1\nb 3\n")
    main(["words", str(tmp_path / "lines.txt"), "--out", str(tmp_path / "out")])
    text = "".join(open(p).read() for p in glob.glob(f"{tmp_path}/out/part-*"))
    assert sorted(text.splitlines()) == ["a\t1 occurences", "b\t5 occurences"]


class FakeSession:
    """Only what the choice of the shared folder looks at."""

    def __init__(self, master, configured):
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"{master}-{configured}")
        self.conf = SimpleNamespace(get=lambda key, default: configured)


def test_shared_folder_comes_from_the_session():
    assert shared_dir(FakeSession("yarn", "hdfs:///scratch/")) == "hdfs:///scratch"
    local = FakeSession("local[2]", None)
    assert shared_dir(local) == shared_dir(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("yarn", None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("local-cluster[2,1,1024]", None))


def test_written_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    assert session.new_table_path(spark, "t").startswith(session.tables_dir(spark) + "/t-")
    # Another folder, as other tests still read the tables of this application.
    monkeypatch.setattr(session, "tables_dir", lambda spark: f"file://{tmp_path}/tables")
    other = tmp_path / "other"
    other.mkdir()
    session.write_table(spark.range(5), "five")
    assert len(glob.glob(f"{tmp_path}/tables/five-*")) == 1
    assert session.drop_tables(spark) and not (tmp_path / "tables").exists() and other.exists()
    assert not session.drop_tables(spark)
