"""Encoding, fingerprints, language model and secrets against plain versions."""

import math
import random
import zlib
from collections import Counter
from hashlib import sha256
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pairclf.llm import near_duplicates
from pairclf.llm.bpe import Codec, encode_texts, read_spec
from pairclf.llm.common import map_batches, text_chunks
from pairclf.llm.lattice_lm import Lattice, words_of
from pairclf.llm.prefix_hashes import code_points, common_extension, fingerprint, likeness, prefix_array, span_hashes
from pairclf.llm.queries import QUERIES, VOCABULARY
from pairclf.llm.secrets import find_secrets

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def codec():
    return Codec(read_spec(VOCABULARY))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoding_equals_the_library_on_odd_texts(codec, library):
    random.seed(3)
    parts = ["a", "b", " ", "  ", "\n", "é", "the", "ing", "'s", "1", "23", "🎉", "漢", "<|endoftext|>", "\x1c", "\x85", "ⰰ", "࢏", " "]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(chr(random.randint(97, 122)) for _ in range(random.randint(0, 80))) for _ in range(1500)]
    texts += ["a" * 5000, "ab" * 3000, " " * 3000, "<|endoftext|><|endoftext|>"]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == ids
        assert codec.decode(np.array(ids, dtype=np.uint32)) == library.decode(ids, skip_special_tokens=False)


def test_pieces_equal_the_library_for_all_latin_characters(codec, library):
    for c in map(chr, range(0x250)):
        for near in "a1 !'\n ":
            text = f"a{c}{near}1{c}  {near}{c}b{near}{c}{c}"
            assert codec.split_pieces(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_encoding_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for row in QUERIES["op3_bpe"](spark, SF_DIR).collect():
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == sha256(decoded.encode()).hexdigest()


def test_encoded_texts_come_back(spark):
    texts = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in encode_texts(texts, VOCABULARY).collect()}
    assert rows[1]["decoded"] == "a b" and rows[2]["ids"] == [] and rows[2]["decoded"] == ""


def test_workers_give_memory_back_after_each_batch(spark):
    def work(batches):
        import pyarrow as pa

        real, calls = pa.default_memory_pool, []

        class Pool:
            def release_unused(self):
                calls.append(1)

        pa.default_memory_pool = Pool
        try:
            for _ in batches:
                for _ in range(3):
                    yield pa.RecordBatch.from_pydict({"calls": pa.array([len(calls)], pa.int64())})
        finally:
            pa.default_memory_pool = real

    rows = map_batches(spark.range(1, numPartitions=1), work, "calls bigint").collect()
    assert [r["calls"] for r in rows] == [0, 1, 2]


def test_a_batch_is_not_held_while_the_next_one_is_read():
    held, before = [], pa.total_allocated_bytes()

    def batches():
        for _ in range(4):
            held.append(pa.total_allocated_bytes() - before)
            yield pa.RecordBatch.from_arrays([pa.array(["x" * 1_000_000])], names=["text"])

    for piece in text_chunks(batches()):
        assert piece.num_rows == 1
        del piece
    assert len(held) == 4 and max(held) < 1_000_000


def test_signing_leaves_no_words_in_the_worker():
    batch = pa.RecordBatch.from_pydict({"node": [1, 2], "text": ["one two three four five six", "two"]})
    signed = list(near_duplicates._sign(iter([batch])))
    assert [b.num_rows for b in signed] == [2] and not near_duplicates._word_hashes


def test_span_hashes_tell_equal_spans_and_extensions():
    random.seed(4)
    for _ in range(60):
        text = "".join(random.choice("ab") for _ in range(random.randint(0, 40)))
        other = "".join(random.choice("ab") for _ in range(random.randint(0, 40)))
        arrays = [[prefix_array(code_points(t), n) for n in range(2)] for t in (text, other)]
        for size in range(1, min(len(text), len(other)) + 1):
            i, j = random.randrange(len(text) - size + 1), random.randrange(len(other) - size + 1)
            same = all(
                span_hashes(arrays[0][n], np.array([i]), size, n)[0] == span_hashes(arrays[1][n], np.array([j]), size, n)[0] for n in range(2)
            )
            assert same == (text[i : i + size] == other[j : j + size])
        i, j = random.randint(0, len(text)), random.randint(0, len(other))
        expected = 0
        while i + expected < len(text) and j + expected < len(other) and text[i + expected] == other[j + expected]:
            expected += 1
        assert common_extension(arrays[0], i, arrays[1], j) == expected


def test_edited_fingerprints_follow_the_next_text(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    texts = [r["text"] or "" for r in rows]
    got = {r["doc_id"]: r for r in QUERIES["op5_prefix_hashes"](spark, SF_DIR).collect()}

    def described(text):
        points = code_points(text)
        return fingerprint(points, [prefix_array(points, n) for n in range(2)])

    assert len(got) == len(rows)
    for i, row in enumerate(rows):
        text, following = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        mine = got[row["doc_id"]]
        assert mine["n_chars"] == len(text) and mine["edited_sha256"] == sha256(edited.encode()).hexdigest()
        assert mine["fingerprint"] == described(text) and mine["edited_fingerprint"] == described(edited)
        assert mine["near_next"] == likeness(described(text), described(following))
        assert mine["kept_prefix"] >= len(text) - half
    unlike = [r for r in got.values() if r["n_chars"] > 200 and r["near_next"] < 0.5]
    assert np.mean([r["near_edited"] > r["near_next"] for r in unlike]) > 0.95


def test_lattice_adds_up_all_segmentations():
    pieces = [b"", b" ", b"a", b"b", b"ab", b" a", b"bab", b"ba"]
    probability = np.array([0.0, 0.1, 0.2, 0.15, 0.1, 0.15, 0.05, 0.15, 0.1])
    with np.errstate(divide="ignore"):
        lattice = Lattice(pieces, np.log(probability))
    for word in (b"a", b"ab", b"babab", b"abba"):
        raw, total = b" " + word, 0.0
        for cuts in range(len(raw)):
            for places in combinations(range(1, len(raw)), cuts):
                bounds = [0, *places, len(raw)]
                parts = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
                if all(p in pieces for p in parts):
                    total += math.prod(probability[pieces.index(p)] for p in parts)
        assert math.isclose(lattice[word], math.log(total), rel_tol=1e-12)


def test_language_model_base_scores_equal_plain_counts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    tokens = {r["doc_id"]: [*words_of(r["text"] or ""), b""] for r in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(t for i, ts in tokens.items() if not held[i] for t in ts)
    total = sum(counts.values())
    for row in QUERIES["op8_lattice_lm"](spark, SF_DIR).collect():
        own = tokens[row["doc_id"]]
        expected = math.fsum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in own)
        assert math.isclose(row["base_score"], expected, rel_tol=1e-9)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(own), sum(t in counts for t in own), total)
        assert row["held_out"] == held[row["doc_id"]] and row["score"] < 0


def test_rare_words_are_scored_by_the_join_alike(spark, monkeypatch):
    from pairclf.llm import lattice_lm

    before = {r["doc_id"]: r for r in QUERIES["op8_lattice_lm"](spark, SF_DIR).collect()}
    monkeypatch.setattr(lattice_lm, "HEAVY_WORDS", 50)
    for row in QUERIES["op8_lattice_lm"](spark, SF_DIR).collect():
        assert math.isclose(row["base_score"], before[row["doc_id"]]["base_score"], rel_tol=1e-9)
        assert row["n_known"] == before[row["doc_id"]]["n_known"]


def test_widely_held_values_are_examples_and_others_live(spark):
    text = "token = abcdefghijkl0 and password=XYZ"
    rows = [(i, f"{i} {text}", f"s{i}") for i in range(4)] + [(9, "é api_key: 'QQQQQQQQQQQQ'", "s9")]
    found = {r["doc_id"]: r for r in find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert found[0]["all_spans"] == found[0]["base_spans"] == ["assign:2:23"]
    assert found[9]["all_spans"] == ["assign:2:24", "live:2:24"]
    assert [s["owners"] for s in found[0]["found"]] == [4]
