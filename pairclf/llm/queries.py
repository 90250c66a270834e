"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bpe import encode_digests
from .common import crc_bucket, table
from .fill_in_middle import fill_in_middle, restored
from .filter_audit import filter_audit
from .lattice_lm import score_texts
from .line_templates import drop_recurring_lines
from .mixing import mix
from .near_duplicates import near_duplicate_classes
from .preferences import conversations, format_preferences, with_foreign_replies, with_next
from .prefix_hashes import edited_fingerprints
from .secrets import KINDS, find_secrets
from .token_files import read_token_files, write_token_files
from .top_k import top_k
from .toxicity import fit, labelled_sample, score

#: The vocabulary file of the encoding queries.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: That of the token files.
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    replied = turns.filter("role = 'assistant' AND conv_id IS NOT NULL").select(F.col("conv_id").alias("id")).distinct()
    pairs = with_foreign_replies(conversations(turns), with_next(replied), F.col("id"))
    formatted = format_preferences(pairs)

    def joined(side: str):
        return F.array_join(F.transform(side, lambda s: s["text"]), "")

    def mask(side: str):
        return F.array_join(F.transform(side, lambda s: F.when(s["train"], "1").otherwise("0")), "")

    return formatted.select(
        F.col("id").alias("conv_id"),
        "prefix_turns",
        "prompt",
        joined("chosen").alias("chosen"),
        mask("chosen").alias("chosen_mask"),
        joined("rejected").alias("rejected"),
        mask("rejected").alias("rejected_mask"),
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(
        table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"),
        repository=F.concat_ws("/", "source", "lang"),
        owner=F.col("source"),
    )

    def count(kind: int):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(n).alias(f"n_{kind[0]}") for n, kind in enumerate(KINDS)],
        F.sha2(F.concat_ws(",", "base_spans"), 256).alias("base_sha256"),
        F.concat_ws(",", "all_spans").alias("spans"),
        F.size(F.filter("found", lambda s: s["live"])).cast("bigint").alias("n_live"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["owners"])), F.lit(0)).alias("most_owners"),
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def op5_prefix_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit(labelled_sample(documents, table(spark, sf_dir, "labels")))
    return score(documents, model).select(
        "doc_id",
        (crc_bucket("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "abuse",
        "quotation",
    )


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_bucket("doc_id", 7) == 2
    scored = score_texts(table(spark, sf_dir, "documents"), ~held_out, VOCABULARY)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(documents, lines="n_lines", dropped="n_dropped")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    mixed = mix(documents, F.array("source"), weights=(3, 1, 2), total_percent=150, most_times=2)
    return mixed.select(
        "doc_id", "size", F.col("sources")[0]["size"].alias("source_size"), F.col("sources")[0]["target"].alias("target"), "taken"
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"),
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(spark, write_token_files(table(spark, sf_dir, "documents"), WORD_VOCABULARY))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_preferences": op1_preferences,
    "op2_secrets": op2_secrets,
    "op3_bpe": op3_bpe,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_prefix_hashes": op5_prefix_hashes,
    "op6_top_k": op6_top_k,
    "op7_toxicity": op7_toxicity,
    "op8_lattice_lm": op8_lattice_lm,
    "op9_line_templates": op9_line_templates,
    "op10_mixing": op10_mixing,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_token_files": op12_token_files,
    "op13_filter_audit": op13_filter_audit,
}
