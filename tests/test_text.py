import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pairclf.functions.buckets import split_bucket
from pairclf.functions.names import curve_name, label_from_file_name, task_key
from pairclf.functions.reports import fixed_point
from pairclf.functions.vectors import last_line, parse_vector, vector_text
from pairclf.sources.count_lines import parse_count_lines

from brute import bucket


def column(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row[1] for row in frame.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_labels_of_file_names(spark):
    cases = {
        "Abyssinian_100.jpg.json": "Abyssinian",
        "american_pit_bull_terrier_12.jpg.json": "american_pit_bull_terrier",
        "_x_1.jpg.json": "x",
        "pug9mix_3.jpg.json": "pugmix",
        "a.json": "",
        "123456789": "",
        "": "",
    }
    assert column(spark, list(cases), label_from_file_name) == list(cases.values())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab_9.é", max_size=16), min_size=1, max_size=30))
def test_labels_of_any_name(spark, names):
    expected = []
    for name in names:
        letters = "".join(c for c in name if c not in "0123456789")
        expected.append(letters[: max(len(letters) - 9, 0)].strip("_"))
    assert column(spark, names, label_from_file_name) == expected


def test_vectors(spark):
    cases = {
        "[1.0,2.0]": [1.0, 2.0],
        "9,9\n[3.0,4.0]": [3.0, 4.0],
        "5,6\n": [5.0, 6.0],
        "[1,2]\n": [1.0, 2.0],
        "[ 1.5 , 1e-3]\n\n": [1.5, 0.001],
        "[-inf,2]": [float("-inf"), 2.0],
    }
    assert column(spark, list(cases), lambda v: parse_vector(last_line(v))) == list(cases.values())
    assert column(spark, ["", " \n \n"], last_line) == [None, None]


@pytest.mark.parametrize("text", ["[1,x]", "[]", "1,,2"])
def test_bad_number_raises(spark, text):
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        with pytest.raises(Exception, match="not a number"):
            column(spark, [text], parse_vector)
    spark.conf.set("spark.sql.ansi.enabled", "true")


def test_vector_text_round_trip(spark):
    text = "[0.1, -2.0, 1.0E-7]"
    assert column(spark, [text], lambda v: vector_text(parse_vector(v))) == [text]


def test_buckets(spark):
    names = [f"a_{i}.jpg.json" for i in range(200)]
    assert column(spark, names, split_bucket) == [bucket(n) for n in names]
    assert column(spark, names, lambda v: split_bucket(v, "x")) == [bucket("x" + n) for n in names]


def test_keys(spark):
    assert column(spark, ["b"], lambda v: task_key(F.lit("a"), v)) == ["a_vs._b"]
    name = curve_name(F.lit(0.2), F.lit("a"), F.lit("All"))
    assert column(spark, ["b"], lambda v: name) == ["0.2_Obs_a_vs_All.png"]


def test_fixed_point_matches_printf(spark):
    values = [k / n for n in (7, 16, 48, 80, 2000) for k in range(n + 1)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in frame.select(fixed_point(F.col("v"), 3)).collect()]
    assert got == ["%.3f" % v for v in values]
    assert frame.limit(1).select(fixed_point(F.lit(1500), 2)).first()[0] == "1500.00"


def test_count_lines(spark):
    frame = spark.createDataFrame([("  a\t 1 ",), ("b -3",), ("c +4",)], "value string")
    assert [tuple(r) for r in parse_count_lines(frame).collect()] == [("a", 1), ("b", -3), ("c", 4)]


@pytest.mark.parametrize("line", ["a", "a 1 2", "", "a x", "a 1.0"])
def test_bad_count_line_raises(spark, line):
    frame = spark.createDataFrame([(line,)], "value string")
    with pytest.raises(Exception, match="not a 'word count' line"):
        parse_count_lines(frame).collect()


@pytest.mark.parametrize("text", ["1.5f", "0x1p3", "1d", "1e", "--1", ""])
def test_only_plain_numbers_are_numbers(spark, text):
    frame = spark.createDataFrame([(f"[1.0,{text}]",)], "line string")
    with pytest.raises(Exception, match="not a number"):
        frame.select(parse_vector(F.col("line"))).collect()


def test_numbers_with_signs_exponents_and_infinities(spark):
    frame = spark.createDataFrame([("[ -1.5e-3 , +2. , .5,inf,-Infinity, 7]",)], "line string")
    row = frame.select(parse_vector(F.col("line")).alias("v")).first()
    assert row["v"] == [-1.5e-3, 2.0, 0.5, float("inf"), float("-inf"), 7.0]
