"""The corpus pipeline: toxicity, recurring lines, near duplicates, mixing, encoding.

Every stage takes the documents that the stage before it kept and returns documents;
the last returns token ids. Stages are written as Parquet and read again, so a lost
executor costs its own tasks only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairclf.llm.bpe import encode_checked
from pairclf.llm.common import table
from pairclf.llm.line_templates import drop_recurring_lines
from pairclf.llm.mixing import mix
from pairclf.llm.near_duplicates import near_duplicate_classes
from pairclf.llm.queries import VOCABULARY
from pairclf.llm.toxicity import fit, labelled_sample, score_column
from pairclf.session import write_table

#: Documents that score as much are rejected.
TOXIC = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic, by a fit on the labels of documents. A null
    text counts as empty; equal texts have equal scores."""
    model = fit(labelled_sample(docs, table(spark, sf_dir, "labels")))
    return docs.filter(score_column(spark, model) < TOXIC)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; those of which nothing is left go. Null and empty
    texts stay as they are."""
    cut = drop_recurring_lines(docs, dropped="_lines_dropped")
    cut = cut.filter((F.col("_lines_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("_lines_dropped") > 0, length).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the least id. Of several rows
    with that id the least stays, by text and then by the other columns of documents;
    documents without an id stay."""
    classes = near_duplicate_classes(docs)
    kept = write_table(classes.filter("doc_id = class_id").select("doc_id").distinct(), "kept-documents")
    named = docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    # Ids are counted without their texts; only rows of repeated ids are grouped.
    repeated = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select("doc_id")
    repeated = write_table(repeated, "repeated-ids")
    out = named.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    if not repeated.isEmpty():
        order = F.struct(*[c for c in ("text", "lang", "source", "n_chars") if c in docs.columns])
        least = named.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), order).alias("_row"))
        out = out.unionByName(least.select("_row.*"))
    return out.unionByName(docs.filter("doc_id IS NULL"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole."""
    rows = docs.select(*[F.col(c).alias(f"_{c}") for c in docs.columns])
    others = tuple(c for c in rows.columns if c != "_doc_id")
    mixed = mix(rows, F.array("_source"), (3, 1, 2), 150, 2, identity="_doc_id", text="_text", keep=others)
    taken = mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return taken.select(*[F.col(f"_{c}").alias(c) for c in docs.columns])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to the text."""
    coded = encode_checked(docs, VOCABULARY, keep=("doc_id", "lang", "source"))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        "round_trip",
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: Fits and signatures have no SQL form; tests compare every stage with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
