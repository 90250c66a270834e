"""Language-model scores from a subword lattice, beside a word model.

The pieces are those of an existing vocabulary. Their probabilities come from the
words of the training texts, segmented by the vocabulary's own encoder and counted
over the whole corpus. The probability of a word, with the space before it, is the sum
over all ways to write it as pieces; a forward recursion over the bytes adds up the
paths in log space. No piece has a space but at its start, so the marginal probability
of a text is the product over its words and the end of the text.

The base score is a word model with add-one smoothing. Its most frequent words, up to
``HEAVY_WORDS``, go to every task; the others are joined to their counts.

A null text counts as empty: it has the end alone. Words are what lies between ASCII
white space; A-Z count as a-z. Repeated rows give repeated rows. Without training
texts all pieces are as likely, and a word has the base probability 1 / (0 + 0 + 1).
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import write_table
from .bpe import codec, read_spec
from .common import map_batches, text_chunks, whole_text

#: Words whose counts go to every task: some 10 MB.
HEAVY_WORDS = 200_000
#: Words that a task counts before it hands its counts on.
HELD_WORDS = 200_000
#: Words that a worker remembers with their lattice scores.
CACHED_WORDS = 250_000
#: What is added to the count of every usable piece.
SMOOTHING = 0.1
#: The end of a text, which no word can be.
END = b""


def words_of(text: str) -> list[bytes]:
    """Bytes split at ASCII white space, A-Z lowered: both are what bytes methods do."""
    return text.encode().lower().split()


def _counts(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "count"]
    )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in text_chunks(batches):
        for text in batch.column("text").to_pylist():
            counts.update(words_of(text))
        counts[END] += batch.num_rows
        if len(counts) >= HELD_WORDS:
            yield _counts(counts)
            counts = Counter()
    if counts:
        yield _counts(counts)


def word_counts(texts: DataFrame) -> DataFrame:
    """word, count over all rows of ``texts``, the end of each text included."""
    counted = map_batches(texts.select(whole_text().alias("text")), _count_words, "word binary, count bigint")
    return write_table(counted.groupBy("word").agg(F.sum("count").alias("count")), "lm-words")


def _heavy_words(learnt: DataFrame, divisor: int) -> dict[bytes, float]:
    """The base scores of the most frequent words, HEAVY_WORDS at most: all words from
    the least count on that lets no more through. Steps of counts are told by their
    logarithms, of which there are some hundreds in any corpus."""
    step = F.floor(F.log2("count") * 8).cast("int")
    held, least = 0, None
    for row in sorted(learnt.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        held += row["count"]
        if held > HEAVY_WORDS:
            break
        least = row["step"]
    if least is None:
        return {}
    top = learnt.filter(step >= least).select("word", "count").toArrow()
    return {w: math.log10((c + 1) / divisor) for w, c in zip(top["word"].to_pylist(), top["count"].to_pylist())}


def usable(raw: bytes) -> bool:
    """Whether a lowered word with the space before it can have this piece."""
    return raw == raw.lower() and not any(c in b" \t\n\x0b\x0c\r" for c in raw[1:]) and raw[:1] not in (b"\t", b"\n", b"\x0b", b"\x0c", b"\r")


def _count_pieces(spec):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = codec(spec.value).vocabulary
        counts = np.zeros(len(vocabulary.token_bytes) + 1, dtype=np.int64)
        for batch in batches:
            for word, count in zip(batch.column("word").to_pylist(), batch.column("count").to_pylist()):
                if word == END:
                    counts[-1] += count
                else:
                    for token in vocabulary.encode_piece(b" " + word):
                        counts[token] += count
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held])], names=["piece", "count"])

    return work


def piece_log_probabilities(words: DataFrame, spec) -> np.ndarray:
    """Natural log-probability of each piece and, last, of the end; -inf for pieces that
    no word can have. Sums of the size of the vocabulary come to the driver."""
    vocabulary = codec(spec.value).vocabulary
    sums = map_batches(words, _count_pieces(spec), "piece int, count bigint").groupBy("piece").agg(F.sum("count").alias("count")).collect()
    counts = np.full(len(vocabulary.token_bytes) + 1, -1.0)
    for raw, token in vocabulary.by_bytes.items():
        if usable(raw):
            counts[token] = 0.0
    counts[-1] = 0.0
    for row in sums:
        counts[row["piece"]] += row["count"]
    open_pieces = counts >= 0
    mass = np.where(open_pieces, counts + SMOOTHING, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(mass / mass.sum())


class Lattice(dict):
    """Word -> natural log of the sum over all its segmentations."""

    def __init__(self, token_bytes: list[bytes], log_probability: np.ndarray):
        self.machine = ahocorasick.Automaton()
        for token, raw in enumerate(token_bytes):
            if raw and math.isfinite(log_probability[token]):
                self.machine.add_word(raw.decode("latin-1"), (len(raw), float(log_probability[token])))
        self.machine.make_automaton()
        self.end = float(log_probability[-1])

    def marginal(self, raw: bytes) -> float:
        forward = [0.0] + [-math.inf] * len(raw)
        exp, log1p = math.exp, math.log1p
        for last, (size, piece) in self.machine.iter(raw.decode("latin-1")):
            path = forward[last + 1 - size] + piece
            so_far = forward[last + 1]
            if path <= so_far:
                forward[last + 1] = so_far + log1p(exp(path - so_far))
            elif so_far == -math.inf:
                forward[last + 1] = path
            else:
                forward[last + 1] = path + log1p(exp(so_far - path))
        return forward[-1]

    def __missing__(self, word: bytes) -> float:
        value = self.marginal(b" " + word)
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


_models: dict[str, tuple[Lattice, dict[bytes, float]]] = {}


def _model(key: str, shared) -> tuple[Lattice, dict[bytes, float]]:
    """The model of this key; a worker keeps the last one for its further tasks."""
    if key not in _models:
        _models.clear()
        spec, log_probability, heavy = shared.value
        _models[key] = Lattice(codec(spec).vocabulary.token_bytes, log_probability), heavy
    return _models[key]


def _score(shared, key: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, heavy = _model(key, shared)
        for batch in text_chunks(batches):
            total, known, base, score, sizes = [], [], [], [], [0]
            tail_words, tail_counts = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                counts = Counter(words)
                counts[END] = 1
                parts, marginal, seen = [], lattice.end / math.log(10), 0
                marginals = []
                for word, count in counts.items():
                    weight = heavy.get(word)
                    if weight is None:
                        tail_words.append(word)
                        tail_counts.append(count)
                    else:
                        parts.append(count * weight)
                        seen += count
                    if word:
                        marginals.append(count * lattice[word])
                total.append(len(words) + 1)
                known.append(seen)
                base.append(math.fsum(parts))
                score.append(marginal + math.fsum(marginals) / math.log(10))
                sizes.append(len(tail_words))
            offsets = pa.array(sizes, pa.int32())
            columns = [pa.array(total, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(score)]
            columns += [
                pa.ListArray.from_arrays(offsets, pa.array(tail_words, pa.binary())),
                pa.ListArray.from_arrays(offsets, pa.array(tail_counts, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *columns],
                names=[*batch.schema.names[:-1], "n_tokens", "known", "base", "score", "words", "counts"],
            )

    return work


def score_texts(documents: DataFrame, training: Column, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, n_tokens, n_known, train_tokens, base_score and score (log10), one row
    for each row of ``documents``; ``training`` tells the rows to learn from."""
    context = documents.sparkSession.sparkContext
    spec = context.broadcast(read_spec(path))
    learnt = word_counts(documents.filter(training).select(F.col(text).alias("text")))
    sizes = learnt.agg(F.sum("count"), F.count(F.lit(1))).first()
    tokens, distinct = sizes[0] or 0, sizes[1]
    divisor = tokens + distinct + 1
    heavy = _heavy_words(learnt, divisor)
    shared = context.broadcast((spec.value, piece_log_probabilities(learnt, spec), heavy))
    rows = documents.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], whole_text(text).alias("text"))
    kept = "".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}, " for i in range(len(keep)))
    schema = f"{kept}n_tokens bigint, known bigint, base double, score double, words array<binary>, counts array<int>"
    scored = map_batches(rows, _score(shared, uuid.uuid4().hex), schema).withColumn("row", F.monotonically_increasing_id())
    # Written, so that every later read has the same row numbers.
    scored = write_table(scored, "lm-scores")
    tail = scored.select("row", F.explode(F.arrays_zip("words", "counts")).alias("tail")).select(
        "row", F.col("tail.words").alias("word"), F.col("tail.counts").alias("times")
    )
    met = tail.join(learnt, "word", "left")
    rest = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((F.coalesce("count", F.lit(0)) + 1) / F.lit(float(divisor)))).alias("rest"),
        F.sum(F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0)).alias("met"),
    )
    joined = scored.drop("words", "counts").join(rest, "row", "left")
    return joined.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        "n_tokens",
        (F.col("known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        "score",
    )
