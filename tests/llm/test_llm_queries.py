"""Registered queries beside their SQL, and odd tables for every operator."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_oracle import compare, connect
from pairclf.llm.queries import QUERIES
from pairclf.llm.sql import ORACLE

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, node string, content string"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name) is None


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert [len([n for n in QUERIES if n.startswith(f"op{i}_")]) for i in range(1, 14)] == [1] * 13


def odd_documents(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows and
    columns whose names the operators use themselves."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "one two three four five six", "en", "a", 1),
        (1, "one two three four five six", "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, " \n\t ", "en", None, 4),
        (5, long, "en", "a", len(long)),
        (6, "password = AbCdEf123456 and idiot", "en", "b", None),
        (None, "one two three four five six", "en", "a", 1),
        (7, "naïve ÉTÉ 漢字 🎉 one", None, "c", 3),
        (8, "One TWO three four five six", "en", "b", 1),
    ]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCUMENTS)


def write_tables(spark, path, documents):
    documents.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (6, 0, 1), (None, 1, 1), (7, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    spark.createDataFrame(
        [
            (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (0, 0, None, None), (0, 1, "assistant", None), (0, 1, "assistant", None),
            (None, 0, "user", "x"), (2, None, "assistant", "alone"), (4, 0, "user", "q"), (5, 0, "user", "q"),
        ],
        "conv_id bigint, turn bigint, role string, text string",
    ).write.parquet(f"{path}/conversations.parquet")
    spark.createDataFrame(
        [
            (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (3, None, 1), (4, [1.0, None], 1),
            (5, [1.0, float("nan")], 1), (6, [float("inf"), 1.0], 1), (100, [-1.0, 0.5], 1), (None, [9.0, 9.0], 1),
        ],
        "vec_id bigint, embedding array<double>, label int",
    ).write.parquet(f"{path}/embeddings.parquet")


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    write_tables(spark, path, odd_documents(spark))
    return path


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "conversations", "embeddings"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return path


def connect_folders(path):
    connection = duckdb.connect()
    for name in ("documents", "labels", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_odd_rows_and_empty_tables(spark, odd_dir, empty_dir, name):
    rows = QUERIES[name](spark, odd_dir).collect()
    if name not in ("op1_preferences", "op6_top_k", "op13_filter_audit"):
        ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)
        assert ids == sorted((i is None, i or 0) for i in [1, 1, 2, 3, 4, 5, 6, None, 7, 8])
    assert QUERIES[name](spark, empty_dir).collect() == []
    if name in ORACLE:
        assert compare(spark, connect_folders(odd_dir), odd_dir, name) is None


def test_columns_keep_their_types(spark, odd_dir):
    kinds = {name: dict(QUERIES[name](spark, odd_dir).dtypes) for name in ("op2_secrets", "op6_top_k", "op7_toxicity")}
    assert kinds["op2_secrets"]["n_hex"] == "bigint" and kinds["op6_top_k"]["rank"] == "int"
    assert kinds["op7_toxicity"]["held_out"] == "boolean" and kinds["op7_toxicity"]["predicted"] == "int"
    held = QUERIES["op7_toxicity"](spark, odd_dir).filter(F.col("doc_id") == 6).first()
    assert 0 <= held["score"] <= 1


def test_pipeline_on_odd_and_empty_tables(spark, odd_dir, empty_dir):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, odd_dir).collect()
    assert {r["doc_id"] for r in rows} <= {1, 2, 3, 4, 5, 6, 7, 8, None} and all(r["round_trip"] for r in rows)
    assert {2, 3} & {r["doc_id"] for r in rows} == set()  # without words they are never taken by the mix
    assert corpus_pipeline.run(spark, empty_dir).collect() == []


def test_pipeline_stages_with_clashing_names_and_another_order_of_columns(spark, odd_dir):
    import corpus_pipeline

    docs = odd_documents(spark).withColumn("score", F.lit(0.5)).withColumn("taken", F.lit("x")).withColumn("_row", F.lit(1))
    docs = docs.select("text", "score", "taken", "_row", *[c for c in docs.columns if c not in ("text", "score", "taken", "_row")])
    docs = docs.union(docs.filter("doc_id = 7").withColumn("text", F.lit("an earlier text of the same id")))
    # With two labels the fit may reject all; the other stages get the whole table.
    scored = corpus_pipeline.toxicity(spark, docs, odd_dir)
    assert scored.columns == docs.columns and scored.count() <= docs.count()
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        columns = docs.columns
        docs = stage(spark, docs, odd_dir).cache()
        assert docs.columns == columns, name
        if name == "near duplicates":
            assert [r["text"] for r in docs.filter("doc_id = 7").collect()] == ["an earlier text of the same id"]
            assert docs.filter("doc_id = 8").isEmpty()  # a copy of 1 but for its capitals
            assert docs.filter("doc_id IS NULL").count() == 1
    assert corpus_pipeline.encoding(spark, docs, odd_dir).filter("NOT round_trip").count() == 0
