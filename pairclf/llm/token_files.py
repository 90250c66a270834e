"""Token ids in binary files: frequency ranks in a byte-aligned code of variable length.

A file holds the ids of some documents one after the other. Ids are replaced by their
rank by frequency in the file (ties to the smaller id), so the 256 most frequent ids take
one byte, the next 65280 two. Every rank is written in 1 to 4 bytes, and its length less
one as two bits of a control byte; control bytes lie apart from the data. A table of all
256 control bytes gives four lengths at once, sums of lengths give the places of the
ranks, and numpy gathers them.

All numbers are little-endian. A file is

    bytes 0-3    TIDS
    bytes 4-31   version (u4), documents (u8), ids (u8), ranks (u8)
    then         the id of each rank (u4); per document its id (i8), 1 if that id is null
                 (u1) and its number of token ids (u8); control bytes; data bytes

Files hold whole documents, so a file is larger than ``FILE_IDS`` ids only where it holds
one document. A table beside them, the manifest, names the files of the tasks that
succeeded, in the order of the documents, with the number of ids before each; files of
repeated tasks are in no manifest.

Documents lie in ascending order of their id, those without one first; rows of one id in
the order of a hash of their text, so equal rows lie together. A null text is empty, and
an empty text has the end id alone.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from ..session import new_table_path, write_table
from .bpe import read_spec
from .common import map_batches, text_chunks, whole_text

MAGIC = b"TIDS"
VERSION = 1
HEADER = struct.Struct("<4sIQQQ")
#: Ids of a file, and ids that are coded at once, a multiple of four.
FILE_IDS = 4_000_000
SLICE_IDS = 1 << 18
#: Ids below this are counted in an array, others by sorting; the ranks are the same.
COUNTED_IDS = 1 << 20
#: Words and pieces that a worker keeps the ids of, in each of two generations, and the
#: length of the longest.
KEPT_WORDS = 20_000
KEPT_PIECES = 200_000
KEPT_BYTES = 48

#: The rules under which words of Latin letters are split here.
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
LETTERS, NUMBERS = "a-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾"
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\x20\x09-\x0D{LETTERS}{NUMBERS}]+").findall
#: Characters of words that the library takes whole: beyond Latin, other white space, and
#: a letter whose lower case is two characters.
BEYOND = re.compile("[^\x00-\x84\x86-\x9f\xa1-\u012f\u0131-\u017f]").search
#: Byte -> the letter that stands for it in the vocabulary: printable Latin-1 as it is, the
#: others in order from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: chr(0x100 + i) for i, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}

#: Control byte -> the lengths of its four ranks, and their sum.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
SPANS = LENGTHS.sum(axis=1).astype(np.int64)


# ---------------------------------------------------------------- the code


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of the ranks."""
    ranks = ranks.astype(np.uint32)
    lengths = 1 + (ranks >> 8 > 0).astype(np.int64) + (ranks >> 16 > 0) + (ranks >> 24 > 0)
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[: len(ranks)] = lengths - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    data = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    data[starts] = ranks & 255
    for place in range(1, int(lengths.max(initial=1))):
        longer = np.flatnonzero(lengths > place)
        data[starts[longer] + place] = ranks[longer] >> (8 * place) & 255
    return control.tobytes(), data.tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    """The ranks again, by table lookup."""
    lengths = LENGTHS[control].ravel()[:count].astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    ranks = data[starts].astype(np.uint32)
    for place in range(1, int(lengths.max(initial=1))):
        longer = np.flatnonzero(lengths > place)
        ranks[longer] |= data[starts[longer] + place].astype(np.uint32) << np.uint32(8 * place)
    return ranks


def by_frequency(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id of each rank, rank of each given id)."""
    if len(ids) and ids.max() < COUNTED_IDS:
        counts = np.bincount(ids)
        known = np.flatnonzero(counts)
        order = known[np.argsort(-counts[known], kind="stable")]
        rank = np.empty(len(counts), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        return order.astype("<u4"), rank[ids]
    known, places, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), dtype=np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    return known[order].astype("<u4"), rank[places]


def write_file(out, documents: list[int | None], ids: list[bytes]) -> None:
    """Write documents, each with its ids as four-byte numbers, to an open file."""
    counts = np.array([len(i) // 4 for i in ids], dtype="<u8")
    table, ranks = by_frequency(np.frombuffer(b"".join(ids), dtype="<u4"))
    coded = [encode_ranks(ranks[start : start + SLICE_IDS]) for start in range(0, len(ranks), SLICE_IDS)]
    out.write(HEADER.pack(MAGIC, VERSION, len(documents), len(ranks), len(table)))
    out.write(table.tobytes())
    out.write(np.array([d or 0 for d in documents], dtype="<i8").tobytes())
    out.write(bytes(d is None for d in documents))
    out.write(counts.tobytes())
    out.writelines(control for control, _ in coded)
    out.writelines(data for _, data in coded)


def read_file(file) -> Iterator[tuple[int | None, int, bool, np.ndarray]]:
    """(document id, its place in the file, whether these are its last ids, ids) of an open
    file. A document comes in slices, so that one of any length is never held whole."""
    magic, version, documents, count, ranks = HEADER.unpack(file.read(HEADER.size))
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a file of token ids")
    table = np.frombuffer(file.read(4 * ranks), dtype="<u4")
    names = np.frombuffer(file.read(8 * documents), dtype="<i8").tolist()
    missing = file.read(documents)
    ends = np.cumsum(np.frombuffer(file.read(8 * documents), dtype="<u8")).astype(np.int64)
    controls = np.frombuffer(file.read(-(-count // 4)), dtype=np.uint8)
    place = 0
    for start in range(0, max(count, 1), SLICE_IDS):
        stop = min(start + SLICE_IDS, count)
        control = controls[start // 4 : -(-stop // 4)]
        size = int(SPANS[control].sum()) - (-stop) % 4  # the last byte's unused places
        ids = table[decode_ranks(control, np.frombuffer(file.read(size), dtype=np.uint8), stop - start)]
        at = start
        while place < documents and not (at == stop and ends[place] > at):
            end = min(int(ends[place]), stop)
            last = end == ends[place]
            yield None if missing[place] else names[place], place, bool(last), ids[at - start : end - start]
            place += last
            at = end


# ---------------------------------------------------------------- encoding


class Kept(dict):
    """Ids by text, made by ``make`` where they are not known, kept in two generations:
    when the younger one is full it becomes the older one, so frequent texts stay."""

    def __init__(self, make: Callable, size: int):
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, text):
        ids = self.older.get(text)
        if ids is None:
            ids = self.make(text)
        if len(text) <= KEPT_BYTES:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


class WordEncoder:
    """Ids of whole texts, by the library, word by word.

    In the vocabularies this serves, no merge and no rule reaches across white space, so a
    text's ids are those of its words. Where the vocabulary's own rules are ``RULES``,
    texts and words of Latin letters are lower-cased and split here, and the library's
    model merges the pieces; any other word goes through the library whole.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        if not self.by_words():
            raise ValueError("this vocabulary does not drop the white space between words")
        parts = json.loads(spec)
        self.special = [token["content"] for token in parts.get("added_tokens", [])]
        self.known_rules = {name: parts.get(name) for name in RULES} == RULES and all(len(s) > 2 and s[:2] == "<|" for s in self.special)
        self.model = self.library.model
        self.words = Kept(self.of_word, KEPT_WORDS)
        self.pieces = Kept(self.of_piece, KEPT_PIECES)

    def by_words(self) -> bool:
        """Whether words joined by white space get the ids of the words."""
        words = ["one", "Two's", "3,4", "a-b", "é", "."]
        alone = [i for w in words for i in self.of_text(w)]
        return all(self.of_text(space + space.join(words) + space) == alone for space in (" ", "\n", "\t\t", "\x0b", "\x0c", "\r\n"))

    def of_text(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def plain(self, text: str) -> bool:
        """Whether the text can be split here."""
        return self.known_rules and "<|" not in text and (text.isascii() or not BEYOND(text))

    def of_word(self, word: bytes) -> bytes:
        text = word.decode()
        if self.plain(text):
            return b"".join(map(self.pieces.__getitem__, PIECES(text.lower())))
        return array("I", self.of_text(text)).tobytes()

    def of_piece(self, piece: str) -> bytes:
        if not piece.isascii() or not piece.isprintable():
            piece = piece.encode().decode("latin-1").translate(BYTE_LETTERS)
        return array("I", [token.id for token in self.model.tokenize(piece)]).tobytes()

    def ids(self, text: str) -> bytes:
        """The ids of a text as four-byte numbers."""
        if self.plain(text):
            return b"".join(map(self.pieces.__getitem__, PIECES(text.lower())))
        return b"".join(map(self.words.__getitem__, text.encode().split()))


@lru_cache(maxsize=1)  # per worker: the vocabulary of a job
def encoder(spec: str) -> WordEncoder:
    return WordEncoder(spec)


# ---------------------------------------------------------------- Spark jobs

MANIFEST = "part int, number int, path string, documents bigint, ids bigint"


def write_token_files(
    documents: DataFrame,
    vocabulary: str,
    end_id: int | None = 1,
    folder: str | None = None,
    identity: str = "doc_id",
    text: str = "text",
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode all texts, write them as token files and return the written manifest: part,
    number, path, documents, ids and ``start``, the number of ids before the file.

    One shuffle sorts the texts over ranges of (id, hash of the text); each task encodes
    and writes its range, file by file. ``folder`` must be one that all executors reach.
    """
    spark = documents.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(vocabulary))
    folder = folder or new_table_path(spark, "token-files")
    _open_folder(folder, create=True)
    rows = documents.select(F.col(identity).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    order = ["doc_id", "tie"]
    ranged = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    written = map_batches(ranged.select("doc_id", "text"), _write_range(spec, end_id, folder, file_ids), MANIFEST)
    files = write_table(written, "token-file-list")
    # One row per range in the first window; a range's own files in the second.
    sizes = files.groupBy("part").agg(F.sum("ids").alias("_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("ids").over(inside), F.lit(0))
    return write_table(files.join(sizes, "part").withColumn("start", start).drop("_before"), "token-files")


def _open_folder(folder: str, create: bool = False):
    """(file system, path inside it)."""
    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
    if create:
        files.create_dir(root, recursive=True)
    return files, root


def _write_range(spec, end_id, folder, file_ids):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        coder, (files, root) = encoder(spec.value), _open_folder(folder)
        ending = b"" if end_id is None else array("I", [end_id]).tobytes()
        held, ids, size, number = [], [], 0, 0

        def written() -> pa.RecordBatch:
            # A name of its own for every try: a repeated task never writes into a file
            # that another one lists.
            name = f"part-{part:06d}-{number:06d}-{uuid.uuid4().hex}.ids"
            with files.open_output_stream(f"{root}/{name}") as out:
                write_file(out, held, ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in (
                    (part, pa.int32()), (number, pa.int32()), (f"{folder}/{name}", pa.string()),
                    (len(held), pa.int64()), (size, pa.int64()),
                )],
                names=["part", "number", "path", "documents", "ids"],
            )

        for batch in text_chunks(batches):
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                coded = coder.ids(text) + ending
                if held and size + len(coded) // 4 > file_ids:
                    yield written()
                    held, ids, size, number = [], [], 0, number + 1
                held.append(name)
                ids.append(coded)
                size += len(coded) // 4
        if held:
            yield written()

    return work


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 (of the ids
    as four-byte numbers) of every document, read from the files of a manifest."""
    return _of_files(spark, manifest, _digests, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_token_ids(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start and ids of every document, read from the files of a manifest."""
    return _of_files(spark, manifest, _whole, "doc_id bigint, start bigint, ids array<bigint>")


def _of_files(spark: SparkSession, manifest: DataFrame, rows_of, schema: str) -> DataFrame:
    listed = manifest.select("path", "start", "ids")
    # The listing is small, the files are not: each file is dealt to a task by itself.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = listed.repartition(tasks, F.xxhash64("path"))
    names = [part.split()[0] for part in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                folder, name = path.rsplit("/", 1)
                files, root = _open_folder(folder)
                with files.open_input_stream(f"{root}/{name}", buffer_size=1 << 20) as file:
                    for rows in rows_of(file, start):
                        yield pa.RecordBatch.from_arrays(rows, names=names)

    return map_batches(dealt, work, schema)


def _digests(file, start: int) -> Iterator[list[pa.Array]]:
    names, starts, counts, sums = [], [], [], []
    count = crc = 0
    for name, _, last, ids in read_file(file):
        crc, count = zlib.crc32(ids.astype("<u4", copy=False).data, crc), count + len(ids)
        if last:
            names.append(name)
            starts.append(start)
            counts.append(count)
            sums.append(crc)
            start, count, crc = start + count, 0, 0
    yield [pa.array(column, pa.int64()) for column in (names, starts, counts, sums)]


def _whole(file, start: int) -> Iterator[list[pa.Array]]:
    held = []
    for name, _, last, ids in read_file(file):
        held.append(ids)
        if last:
            whole = np.concatenate(held).astype(np.int64)
            yield [pa.array([name], pa.int64()), pa.array([start], pa.int64()), pa.array([whole], pa.list_(pa.int64()))]
            start, held = start + len(whole), []
