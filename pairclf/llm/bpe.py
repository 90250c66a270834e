"""Byte-pair encoding and decoding of whole texts.

The encoder takes, at every place of a piece, the longest token that an
Aho-Corasick machine found to begin there, and checks it against the token before
it: two neighbours are compatible when merging their join would not have chosen a
pair across the border. An incompatible token is shortened to its longest proper
prefix that is a token; when none fits, the token before it is taken back and the
place is marked as dead, so no place is tried twice with one token and the work is
linear in the piece. The result is what merging by rank gives. Decoding copies
byte ranges of one blob by an offset table.

Null and empty texts give no tokens. Repeated rows give repeated rows. Only the
named columns are read, so other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import pre_tokenizers

from .common import map_batches, text_chunks, whole_text

# The split pattern of byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The classes of that pattern among the characters up to U+024F.
LATIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-\u024f"
LATIN_NUMBERS = "0-9²³¹¼-¾"
LATIN_SPACES = "\\x09-\\x0d\\x20\\x85\\xa0"

#: Pieces that a worker remembers; it forgets all of them when there are more.
CACHED_PIECES = 100_000
#: Pairs of tokens that a worker remembers, about 130 bytes each.
CACHED_PAIRS = 120_000
#: Longer pieces are encoded anew each time.
CACHED_BYTES = 64


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters stand for themselves, the others follow from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level vocabulary: bytes of tokens, merge ranks, and the machines over them."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        model = parsed["model"]
        to_byte = {letter: byte for byte, letter in byte_letters().items()}
        size = 1 + max([*model["vocab"].values(), *(t["id"] for t in parsed["added_tokens"])])
        self.token_bytes = [b""] * size
        for text, token in model["vocab"].items():
            if all(c in to_byte for c in text):
                self.token_bytes[token] = bytes(to_byte[c] for c in text)
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        for text, token in self.special.items():
            self.token_bytes[token] = text.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocab = model["vocab"]
        self.rank = {}  # token -> place of the merge that makes it
        self.parts = {}  # token -> the two tokens of that merge
        self.merged = {}  # pair -> rank of its merge
        for rank, (left, right) in enumerate(pairs):
            whole, pair = vocab[left + right], (vocab[left], vocab[right])
            self.merged[pair] = rank
            if whole not in self.rank:
                self.rank[whole], self.parts[whole] = rank, pair
        special = set(self.special.values())
        plain = {b: t for t, b in enumerate(self.token_bytes) if b and t not in special}
        # A token that its own merges do not give is never in an encoding.
        self.by_bytes = {b: t for b, t in plain.items() if len(b) == 1 or t in self.rank}
        self.shorter = {}  # token -> its longest proper prefix that is a token
        for raw, token in self.by_bytes.items():
            for length in range(len(raw) - 1, 0, -1):
                if (other := self.by_bytes.get(raw[:length])) is not None:
                    self.shorter[token] = other
                    break
        # Reversed tokens: the longest match that ends at a place of the reversed
        # piece is the longest token that begins at the mirrored place.
        self.machine = ahocorasick.Automaton()
        for raw, token in self.by_bytes.items():
            self.machine.add_word(raw[::-1].decode("latin-1"), (token, len(raw)))
        self.machine.make_automaton()
        self.lengths = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.blob = np.frombuffer(b"".join(self.token_bytes), dtype=np.uint8)
        self._compatible: dict[int, bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` can stand side by side in an encoding: on
        undoing both tokens' merges, latest first, no pair across the border has a
        merge that would have come before the merges still standing."""
        pair = left << 32 | right
        known = self._compatible.get(pair)
        if known is not None:
            return known
        a, b, merged, rank = left, right, self.merged, self.rank
        # Merges that come at this place or later have been undone on the left / right.
        fits, limit = True, len(merged) + 1
        while True:
            crossing = merged.get((a, b))
            if crossing is not None and crossing < limit:
                fits = False
                break
            rank_a, rank_b = rank.get(a, -1), rank.get(b, -1)
            if rank_a < 0 and rank_b < 0:
                break
            if rank_a > rank_b:  # undo the later merge; the left one loses a tie
                limit, a = rank_a, self.parts[a][1]
            else:
                # A pair across the border comes before an equal merge to its right.
                limit, b = rank_b + 1, self.parts[b][0]
        if len(self._compatible) >= CACHED_PAIRS:
            self._compatible.clear()
        self._compatible[pair] = fits
        return fits

    def encode_piece(self, raw: bytes) -> list[int]:
        """The tokens of one piece, exactly as merging by rank gives them."""
        whole = self.by_bytes.get(raw)
        if whole is not None and (len(raw) == 1 or self.reachable(whole)):
            return [whole]
        return self.backtrack(raw)

    def backtrack(self, raw: bytes) -> list[int]:
        size, lengths = len(raw), self.token_bytes
        longest: list = [None] * size
        for end, (token, length) in self.machine.iter(raw[::-1].decode("latin-1")):
            place = size - 1 - end
            if longest[place] is None or length > longest[place][1]:
                longest[place] = (token, length)
        tokens: list[int] = []
        alive = bytearray(b"\x01") * (size + 1)
        place, token = 0, longest[0][0] if size else None
        shorter, compatible = self.shorter, self.compatible
        while token is not None:
            last = tokens[-1] if tokens else None
            while True:
                end = place + len(lengths[token])
                if alive[end] and (last is None or compatible(last, token)):
                    tokens.append(token)
                    place = end
                    token = longest[place][0] if place < size else None
                    break
                token = shorter.get(token)
                if token is None:
                    alive[place] = 0
                    token = tokens.pop()
                    place -= len(lengths[token])
                    break
        return tokens

    @lru_cache(maxsize=None)  # at most one entry per token
    def reachable(self, token: int) -> bool:
        """Whether merging the bytes of the token gives the token alone."""
        return self.backtrack(self.token_bytes[token]) == [token]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, copied from the blob by offsets."""
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        index = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.blob[index].tobytes()


class _Pieces(dict):
    """Piece -> its token ids as four-byte numbers."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        ids = array("I", self.vocabulary.encode_piece(raw)).tobytes()
        if len(raw) <= CACHED_BYTES:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encodes and decodes whole texts with a vocabulary."""

    def __init__(self, spec: str):
        self.vocabulary = Vocabulary(spec)
        self.pieces = _Pieces(self.vocabulary)
        self.split = regex.compile(SPLIT).findall
        letter, number, space = LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACES
        self.split_latin = re.compile(
            rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
        ).findall
        self.beyond_latin = re.compile("[^\x00-\u024f]").search
        self.decimal = [str(i) for i in range(len(self.vocabulary.token_bytes))]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(self.vocabulary.special, key=len, reverse=True)) or r"(?!)")
        self.reference = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.same_class: dict[str, bool] = {}

    def split_pieces(self, text: str) -> list[str]:
        """The pieces of a text. Releases of Unicode differ between libraries in the
        class of some newer characters; a text with such a character is split by the
        tokenizer library's own splitter."""
        if text.isascii() or not self.beyond_latin(text):
            return self.split_latin(text)
        if all(self._known(c) for c in set(text)):
            return self.split(text)
        return [text[a:b] for _, (a, b) in self.reference.pre_tokenize_str(text)]

    def _known(self, c: str) -> bool:
        same = self.same_class.get(c)
        if same is None:
            probe = f"a{c}1{c} {c}b"
            theirs = [probe[a:b] for _, (a, b) in self.reference.pre_tokenize_str(probe)]
            same = self.same_class[c] = self.split(probe) == theirs
        return same

    def encode(self, text: str) -> np.ndarray:
        pieces, parts, at = self.pieces, [], 0
        for match in self.special.finditer(text):
            parts.extend(map(pieces.__getitem__, self.split_pieces(text[at : match.start()])))
            parts.append(np.array([self.vocabulary.special[match.group()]], dtype=np.uint32).tobytes())
            at = match.end()
        parts.extend(map(pieces.__getitem__, self.split_pieces(text[at:] if at else text)))
        return np.frombuffer(b"".join(parts), dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return self.vocabulary.decode(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)  # per worker: the vocabularies of a job
def codec(spec: str) -> Codec:
    return Codec(spec)


def read_spec(path: str) -> str:
    """The vocabulary file as text; its size is checked, as every task gets it."""
    with open(path, encoding="utf-8") as file:
        spec = file.read(64 << 20)
    if len(spec) >= 64 << 20:
        raise ValueError(f"{path} is over 64 MB")
    return spec


ENCODED = "ids array<int>, decoded string"


def encode_texts(documents: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and, per row, the token ids and the text decoded from them."""
    return _encoded(documents, path, text, keep, ENCODED, _ids_and_text)


def encode_digests(documents: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and, per row, n_tokens and the SHA-256 of ids and of decoded text."""
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _encoded(documents, path, text, keep, schema, _digests)


def _encoded(documents, path, text, keep, schema, output) -> DataFrame:
    spec = documents.sparkSession.sparkContext.broadcast(read_spec(path))
    rows = documents.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], whole_text(text).alias("text"))
    kept = ", ".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(spec.value)
        for batch in text_chunks(batches):
            columns = batch.columns[:-1] + output(coder, batch.column("text").to_pylist())
            kept_names = batch.schema.names[:-1]
            del batch  # a slice holds the whole batch that it was cut from
            yield pa.RecordBatch.from_arrays(columns, names=[*kept_names, *names])
            del columns

    names = [part.split()[0] for part in schema.split(", ")]
    coded = map_batches(rows, work, f"{kept}, {schema}")
    return coded.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *names)


def encode_checked(documents: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and, per row, the token ids and whether they decode to the text."""
    return _encoded(documents, path, text, keep, "ids array<int>, round_trip boolean", _ids_and_check)


def _ids_and_check(coder: Codec, texts: list[str]) -> list[pa.Array]:
    ids = [coder.encode(t) for t in texts]
    return [_id_lists(ids), pa.array([coder.decode(i) == t for i, t in zip(ids, texts)], pa.bool_())]


def _ids_and_text(coder: Codec, texts: list[str]) -> list[pa.Array]:
    ids = [coder.encode(t) for t in texts]
    return [_id_lists(ids), pa.array([coder.decode(i) for i in ids], pa.string())]


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    values = pa.array(np.concatenate([np.zeros(0, np.uint32), *ids]).view(np.int32))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _digests(coder: Codec, texts: list[str]) -> list[pa.Array]:
    counts, of_ids, of_text = [], [], []
    for text in texts:
        ids = coder.encode(text)
        counts.append(len(ids))
        of_ids.append(sha256(",".join(map(coder.decimal.__getitem__, ids.tolist())).encode()).hexdigest())
        of_text.append(sha256(coder.decode(ids).encode()).hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
