"""Fill-in-middle, token files and the filter audit against plain versions."""

import io
import random
import zlib
from array import array
from collections import Counter
from hashlib import sha256
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairclf.llm import fill_in_middle as fim
from pairclf.llm import filter_audit as fa
from pairclf.llm import token_files as tf
from pairclf.llm.queries import QUERIES, WORD_VOCABULARY

SF_DIR = "/root/testdata/sf0.001"
TEXTS = ["", " ", "a", "naïve ÉTÉ 漢字 🎉 one", "line one\nline two\n\nthree", "  lead and trail  ", "x" * 5000 + "é" * 3000, "a <P> b"]


def random_text(rng, length):
    return "".join(rng.choice("ab  \n\té漢🎉<PSM>\x1c\x85") for _ in range(length))


# ---------------------------------------------------------------- fill in middle


def test_block_tree_finds_every_unit():
    rng = random.Random(1)
    for size in (0, 1, 2, 3, 7, 8, 9, 40):
        units = [rng.choice([0, 0, 1, 2, 5]) for _ in range(size)]
        points = [u + rng.randrange(3) for u in units]
        tree = fim.BlockTree(units, points)
        assert tree.total() == (sum(units), sum(points))
        owner = [block for block, count in enumerate(units) for _ in range(count)]
        for unit, block in enumerate(owner):
            assert tree.find(unit) == (block, sum(units[:block]), sum(points[:block]))
        assert tree.find(sum(units))[0] == size


def plain_units(text, unit):
    if unit == "character":
        return list(text)
    edges = [0] + [
        i for i in range(1, len(text))
        if (text[i - 1] == "\n" if unit == "line" else text[i - 1] in " \t\n\x0b\x0c\r" and text[i] not in " \t\n\x0b\x0c\r")
    ] + [len(text)]
    return [text[a:b] for a, b in zip(edges, edges[1:])] if text else []


def plain_cut(name, text, unit):
    units = plain_units(text, unit)
    digest = sha256(f"1:{'' if name is None else name}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= 90:
        return (len(units), "plain", None, None, text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, len(units))))
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (len(units), form, len(prefix), len(middle), output)


@pytest.mark.parametrize("unit", ["character", "word", "line"])
def test_cuts_equal_a_plain_version(spark, monkeypatch, unit):
    monkeypatch.setattr(fim, "BLOCK", 7)
    rng = random.Random(2)
    texts = TEXTS + [random_text(rng, rng.randrange(200)) for _ in range(300)]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(3, None), (5, "again"), (5, "again")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = fim.fill_in_middle(df, unit).withColumn("restored", fim.restored()).collect()
    want = Counter((i, *plain_cut(i, t or "", unit), t or "") for i, t in rows)
    assert Counter(tuple(r) for r in found) == want


def test_other_columns_keep_their_names(spark):
    df = spark.createDataFrame([(1, "some text", 7, "f", "h", "k")], "doc_id bigint, text string, n int, form string, hash string, k0 string")
    kept = fim.fill_in_middle(df.withColumnRenamed("n", "size"), keep=("doc_id", "size", "k0"))
    assert kept.first()["size"] == 7 and kept.first()["k0"] == "k"
    assert fim.fill_in_middle(df).count() == 1


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("", "b", "c"), ("ab", "bc", "x"), ("a", "cab", "x")])
def test_marks_that_could_be_mistaken_raise(marks):
    with pytest.raises(ValueError):
        fim.check_marks(marks)


# ---------------------------------------------------------------- token files


def test_ranks_round_trip():
    rng = np.random.default_rng(3)
    for size in (0, 1, 3, 4, 5, 1000):
        ranks = rng.integers(0, 1 << 32, size, dtype=np.uint64) >> rng.integers(0, 32, size, dtype=np.uint64)
        control, data = tf.encode_ranks(ranks)
        assert len(control) == -(-size // 4)
        assert tf.decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), size).tolist() == ranks.tolist()
    control, data = tf.encode_ranks(np.array([0, 255, 256, 65535, 65536]))
    assert len(data) == 1 + 1 + 2 + 2 + 3


@pytest.mark.parametrize("slice_ids", [4, 8, 1 << 20])
def test_files_round_trip_in_slices(monkeypatch, slice_ids):
    monkeypatch.setattr(tf, "SLICE_IDS", slice_ids)
    documents = [None, -5, 7, 7, 9, 10, 11]
    ids = [[], [1], [5, 6, 7, 5, 5], [70_000] * 21, [], [3, 3, 1], []]
    for count in (0, 1, 7):
        file = io.BytesIO()
        tf.write_file(file, documents[:count], [array("I", i).tobytes() for i in ids[:count]])
        file.seek(0)
        got, open_ids = [], []
        for name, place, last, part in tf.read_file(file):
            open_ids += part.tolist()
            if last:
                assert place == len(got)
                got.append((name, open_ids))
                open_ids = []
        assert got == list(zip(documents[:count], ids[:count])) and not open_ids and not file.read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_words_equal_the_library_on_odd_texts(monkeypatch, library):
    monkeypatch.setattr(tf, "KEPT_WORDS", 50)
    monkeypatch.setattr(tf, "KEPT_PIECES", 50)
    coder = tf.WordEncoder(tf.read_spec(WORD_VOCABULARY))
    rng = random.Random(4)
    parts = ["a", "b", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "é", "é", "́", "the", "ing", "'s", "1", "23", "🎉", "漢", "Σ", "ΑΣ",
             "İ", "ǅ", "<|endoftext|>", "<|", "\x1c", "\x85", " ", " ", "　", "‍", "ᄀ", "ᅡ", "ᆨ", "...", "$", "𝒳"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert np.frombuffer(coder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_equal_the_library_for_all_latin_characters(library):
    coder = tf.WordEncoder(tf.read_spec(WORD_VOCABULARY))
    assert coder.known_rules
    for c in map(chr, range(0x250)):
        text = f"a{c}b {c} '{c}{c}s 1{c}2 {c}'ve É{c}, ab{c.upper()}.{c}"
        assert np.frombuffer(coder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(c)


def test_other_rules_go_through_the_library_whole(library):
    import json

    spec = json.loads(tf.read_spec(WORD_VOCABULARY))
    spec["normalizer"]["normalizers"].pop()  # keeps capitals
    coder, other = tf.WordEncoder(json.dumps(spec)), Tokenizer.from_str(json.dumps(spec))
    text = "One TWO three's 4 five."
    assert not coder.known_rules
    assert np.frombuffer(coder.ids(text), "<u4").tolist() == other.encode(text, add_special_tokens=False).ids


def test_a_vocabulary_that_keeps_white_space_raises():
    with pytest.raises(ValueError):
        tf.WordEncoder(tf.read_spec(public_tokenizers.path("byte_bpe_50k.json")))


def plain_files(library, rows):
    """doc_id, start, n_tokens and crc32 of rows in the order of the files."""
    start, out = 0, []
    for name, text in rows:
        ids = array("I", library.encode(text or "", add_special_tokens=False).ids + [1])
        out.append((name, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_file_query_equals_the_library(spark, library):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    got = sorted(tuple(r) for r in QUERIES["op12_token_files"](spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == plain_files(library, rows)


def test_small_files_and_odd_ids(spark, library):
    rows = [(None, "no id"), (None, "no id"), (None, None), (-3, "less"), (4, ""), (4, "two texts"), (2, "word " * 900)]
    rows += [(i, f"text {i} of many") for i in range(10, 200)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, start int").repartition(6)
    manifest = tf.write_token_files(df, WORD_VOCABULARY, file_ids=40)
    assert manifest.count() > 20 and manifest.agg(F.max("ids")).first()[0] == 901
    got = tf.read_token_files(spark, manifest).collect()
    order = sorted(got, key=lambda r: r["start"])
    ids = [r["doc_id"] for r in order]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    lengths = [r["n_tokens"] for r in order]
    assert [r["start"] for r in order] == [sum(lengths[:i]) for i in range(len(lengths))]
    plain = Counter((name, n, crc) for name, _, n, crc in plain_files(library, rows))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == plain
    whole = {(r["doc_id"], tuple(r["ids"])) for r in tf.read_token_ids(spark, manifest).collect()}
    assert (-3, (*library.encode("less", add_special_tokens=False).ids, 1)) in whole and len(whole) == len(set(rows))


def test_most_ids_take_one_byte(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    manifest = tf.write_token_files(documents, WORD_VOCABULARY)
    from pairclf.llm.token_files import _open_folder

    size = ids = 0
    for row in manifest.collect():
        folder, name = row["path"].rsplit("/", 1)
        files, root = _open_folder(folder)
        size += files.get_file_info(f"{root}/{name}").size
        ids += row["ids"]
    assert size < 2 * ids


# ---------------------------------------------------------------- filter audit


def test_trie_holds_the_least_id_of_every_text():
    rng = random.Random(5)
    trie, found, rows = fa.RadixTrie(), [], []
    for _ in range(4000):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(9))).encode()
        rows.append((text, rng.randrange(500)))
        found += [(name, True) for name, kind, count in trie.insert(*rows[-1], "k", 1) for _ in range(count)]
    found += [(name, False) for name, kind, count in trie.traverse() for _ in range(count)]
    least = {}
    for text, name in rows:
        least[text] = min(name, least.get(text, name))
    assert Counter(found) == Counter((name, name > least[text]) for text, name in rows)


def plain_mask(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    capitals = sum("A" <= c <= "Z" for c in text)
    return (len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words)) + 4 * (100 * capitals > 2 * len(text)) + 8 * any(c in "#$%&*|" for c in text)


def audit_rows():
    rng = random.Random(6)
    shared = "the same long beginning of many texts " * 12
    texts = [shared + str(rng.randrange(40)) for _ in range(150)] + ["copied whole " * 30] * 200 + ["", " ", "É$", "ABC"] * 3 + [shared]
    texts += [" ".join(rng.choice("abcdefgh") + str(rng.randrange(90)) for _ in range(rng.randrange(400))) for _ in range(60)]
    rows = [(rng.choice([None, *range(300)]), t, rng.choice(["s", "t", None])) for t in texts] + [(301, None, "s"), (7, "ABC", "s"), (7, "ABC", "s")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("range_bytes", [500, 20_000, 64 << 20])
def test_masks_equal_a_plain_version(spark, range_bytes):
    rows = audit_rows()
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, source string, mask int").repartition(9)
    least = {}
    for name, text, _ in rows:
        if name is not None:
            least[text or ""] = min(name, least.get(text or "", name))
    want = Counter(
        (name, part or "", plain_mask(text or "") | (16 if name is not None and name > least[text or ""] else 0)) for name, text, part in rows
    )
    got = Counter()
    for r in fa.filter_masks(df, F.col("source"), range_bytes=range_bytes, prefix=4).collect():
        got[r["doc_id"], r["part"], r["mask"]] += r["rows"]
    assert got == want


def test_no_range_is_heavy_but_for_copies(spark):
    df = spark.createDataFrame([(t or "",) for _, t, _ in audit_rows()], "text string").repartition(4)
    weights = fa.prefix_weights(df, 2000, 4)
    texts = Counter(r["text"] for r in df.collect())
    for row in weights.collect():
        below = {t: n * len(t.encode()) for t, n in texts.items() if t.startswith(row["prefix"])}
        assert row["weight"] <= 2000 or row["prefix"] in texts
        assert row["weight"] <= sum(below.values())
    assert weights.agg(F.sum("weight")).first()[0] == sum(n * len(t.encode()) for t, n in texts.items())
    borders = fa.range_borders(weights, 2000)
    assert borders == sorted(set(borders)) and len(borders) > 5
    # Borders that take too much room make the ranges larger, and no text is lost.
    assert len(fa.range_borders(weights, 2000, border_bytes=300)) < len(borders)


def test_orders_equal_a_plain_version(spark):
    rows = audit_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 300, 2)] + [(4, 1, None), (None, 1, 1), (6, None, None)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    marks = {}
    for i, q, t in labels:
        good, toxic = marks.get(i, (0, 0))
        marks[i] = (max(good, int(q == 1)), max(toxic, int(t == 1)))
    marks.pop(None)
    label_table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): r for r in fa.filter_audit(df, label_table, F.col("source")).collect()}
    least = {}
    for name, text, _ in rows:
        if name is not None:
            least[text or ""] = min(name, least.get(text or "", name))
    fails = [
        (part or "", plain_mask(text or "") | (16 if name is not None and name > least[text or ""] else 0), *marks.get(name, (0, 0)))
        for name, text, part in rows
    ]
    assert len(got) == 3 * 120 * 5
    shapley = Counter()
    for part in ("", "s", "t"):
        for order in permutations(fa.FILTERS):
            left = [f for f in fails if f[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                bit = 1 << fa.FILTERS.index(letter)
                out = [f for f in left if f[1] & bit]
                left = [f for f in left if not f[1] & bit]
                row = got[part, "".join(order), step]
                assert (row["kept"], row["removed"], row["redundant"]) == (len(left), len(out), sum(bool(f[1] & bit) for f in gone))
                assert row["unique_fails"] == sum(f[0] == part and f[1] == bit for f in fails)
                assert (row["good_lost"], row["toxic_lost"]) == (sum(f[2] for f in out), sum(f[3] for f in out))
                gone += out
                shapley[part, letter] += len(out)
    for (part, order, step), row in got.items():
        assert row["shapley"] == shapley[part, order[step - 1]]
