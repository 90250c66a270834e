import random

from pairclf.operators.words import word_run_totals, word_totals
from pairclf.streaming.count_lines import current_totals, start_totals, stream_count_lines


def lines(spark, pairs):
    return spark.createDataFrame([(i, w, c) for i, (w, c) in enumerate(pairs)], "position long, word string, count long")


def runs_of(pairs):
    runs = []
    for word, count in pairs:
        if runs and runs[-1][0] == word:
            runs[-1][1] += count
        else:
            runs.append([word, count])
    return [(number + 1, word, total) for number, (word, total) in enumerate(runs)]


def test_totals_and_run_totals(spark):
    pairs = [("a", 1), ("a", 2), ("b", 1), ("a", 5)]
    frame = lines(spark, pairs)
    assert {(r["word"], r["total"], r["line"]) for r in word_totals(frame).collect()} == {
        ("a", 8, "a\t8 occurences"), ("b", 1, "b\t1 occurences")
    }
    got = sorted(tuple(r)[:3] for r in word_run_totals(frame, "position").collect())
    assert got == [(1, "a", 3), (2, "b", 1), (3, "a", 5)]


def test_runs_across_ranges(spark):
    random.seed(3)
    for words, stay in (("ab", 0.5), ("abc", 0.999), ("a", 1.0)):
        pairs, word = [], words[0]
        for _ in range(4000):
            word = word if random.random() < stay else random.choice(words)
            pairs.append((word, random.randint(-3, 9)))
        frame = lines(spark, pairs).repartition(7)
        got = sorted(tuple(r)[:3] for r in word_run_totals(frame, "position").collect())
        assert got == runs_of(pairs)


def test_rows_of_runs_are_shuffled_once(spark, monkeypatch):
    from pairclf.operators import words

    plans = []
    real = words.write_table
    monkeypatch.setattr(words, "write_table", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or real(df, name))
    pairs = [(random.choice("ab"), 1) for _ in range(3000)]
    result = word_run_totals(lines(spark, pairs).repartition(5), "position")
    assert sorted(tuple(r)[:3] for r in result.collect()) == runs_of(pairs)
    physical = [plan.split("== Physical Plan ==")[1] for plan in plans]
    assert len(physical) == 1 and physical[0].count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in physical[0]
    # Runs inside a range are final: only marked rows are grouped again.
    last = result._jdf.queryExecution().optimizedPlan().toString()
    assert last.count("Aggregate [run") == 1 and "border" in last


def test_null_words_and_counts_and_equal_positions(spark):
    rows = [(1, None, 2), (2, None, None), (3, "a", None), (4, "a", 1), (4, "b", 1), (4, "a", 5), (5, "b", 2)]
    frame = spark.createDataFrame(rows, "position long, word string, count long")
    got = [tuple(r)[:3] for r in word_run_totals(frame, "position").orderBy("run").collect()]
    assert got == [(1, None, 2), (2, "a", 6), (3, "b", 3)]


def test_no_lines(spark):
    assert word_run_totals(lines(spark, [("a", 1)]).filter("word = 'b'"), "position").collect() == []


def test_stream_totals_grow_with_new_files(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    folder.mkdir()
    (folder / "one.txt").write_text("a 1\nb 2\n")
    start_totals(stream_count_lines(spark, str(folder)), checkpoint, once=True).awaitTermination()
    assert {tuple(r)[:2] for r in current_totals(spark, checkpoint).collect()} == {("a", 1), ("b", 2)}
    (folder / "two.txt").write_text("a 5\nc 1\n")
    start_totals(stream_count_lines(spark, str(folder)), checkpoint, once=True).awaitTermination()
    assert {tuple(r)[:2] for r in current_totals(spark, checkpoint).collect()} == {("a", 6), ("b", 2), ("c", 1)}
