"""Fingerprints from prefix polynomial hashes.

For the code points c_0, c_1, ... of a text the prefix array holds the sums of
c_j * B^j modulo a prime. The hash of any span is the difference of two entries,
shifted by a power of B, so span equality takes constant time and the longest common
extension of two places is found by binary search. A fingerprint has the length and
two whole-text hashes, and for each of 64 classes of span hashes the least one among
all spans of 24 code points; the likeness of two fingerprints is the share of classes
whose least spans agree, an estimate of how many spans the texts have in common.

Null texts count as empty. Two empty texts have a likeness of 1, an empty and another
text of 0. A text shorter than a span is one span.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, text_chunks, whole_text
from .near_duplicates import mixed

PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (911_382_323, 972_663_749)
SPAN = 24
CLASSES = 64
#: Rows that one range of ids should hold, and most ranges.
RANGE_ROWS = 2_000
MAX_RANGES = 20_000


class Powers:
    """Powers of a base and of its inverse modulo a prime, as far as texts have needed."""

    def __init__(self, base: int, prime: int):
        self.base, self.prime = base, prime
        self.inverse = pow(base, -1, prime)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, count: int) -> None:
        while len(self.up) < count:
            size, prime = len(self.up), np.uint64(self.prime)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, self.prime)) % prime])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, size, self.prime)) % prime])


_powers = [Powers(base, prime) for base, prime in zip(BASES, PRIMES)]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def prefix_array(points: np.ndarray, number: int = 0) -> np.ndarray:
    """Entry i is the hash of the first i code points; number tells the prime."""
    powers = _powers[number]
    powers.reach(len(points) + 1)
    prime = np.uint64(powers.prime)
    terms = (points.astype(np.uint64) + np.uint64(1)) * powers.up[: len(points)] % prime
    # Below 2^31 each, so 2^32 of them fit into 64 bits.
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64) % prime])


def span_hashes(prefix: np.ndarray, starts: np.ndarray, size: int, number: int = 0) -> np.ndarray:
    """Hashes of the spans of ``size`` code points at ``starts``."""
    powers = _powers[number]
    prime = np.uint64(powers.prime)
    powers.reach(len(prefix))
    return (prefix[starts + size] + prime - prefix[starts]) % prime * powers.down[starts] % prime


def common_extension(a: list[np.ndarray], i: int, b: list[np.ndarray], j: int) -> int:
    """How many code points from place i of one text and j of the other are equal;
    a and b are the texts' prefix arrays for both primes."""
    low, high = 0, min(len(a[0]) - i, len(b[0]) - j) - 1
    while low < high:
        middle = (low + high + 1) // 2
        if all(
            span_hashes(a[n], np.array([i]), middle, n)[0] == span_hashes(b[n], np.array([j]), middle, n)[0]
            for n in range(len(PRIMES))
        ):
            low = middle
        else:
            high = middle - 1
    return low


def fingerprint(points: np.ndarray, prefixes: list[np.ndarray]) -> str:
    """Length, whole-text hashes and least span hashes of the classes, as hex digits."""
    least = np.full(CLASSES, np.iinfo(np.uint64).max, dtype=np.uint64)
    if len(points):
        size = min(SPAN, len(points))
        prefix, powers = prefixes[0], _powers[0]
        prime, count = np.uint64(powers.prime), len(points) - size + 1
        spans = mixed((prefix[size:] + prime - prefix[:count]) % prime * powers.down[:count] % prime + np.uint64(1))
        classes = (spans >> np.uint64(58)).astype(np.int64)
        np.minimum.at(least, classes, spans)
    whole = "".join(f"{int(p[-1]):08x}" for p in prefixes)
    marks = (least & np.uint64(0xFFFF)).astype(">u2")
    marks[least == np.iinfo(np.uint64).max] = 0xFFFF
    return f"{len(points):010x}{whole}{marks.tobytes().hex()}"


_HEAD = 10 + 8 * len(PRIMES)


def likeness(a: str, b: str) -> float:
    """Share of the classes present in either fingerprint whose least spans agree."""
    if a == b:
        return 1.0
    marks_a, marks_b = (np.frombuffer(bytes.fromhex(x[_HEAD:]), dtype=">u2") for x in (a, b))
    present = (marks_a != 0xFFFF) | (marks_b != 0xFFFF)
    return float(np.mean((marks_a == marks_b)[present])) if present.any() else 0.0


def _described(text: str) -> tuple[np.ndarray, list[np.ndarray], str]:
    points = code_points(text)
    prefixes = [prefix_array(points, n) for n in range(len(PRIMES))]
    return points, prefixes, fingerprint(points, prefixes)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range lie in order and end with the row after its last one."""
    before = None
    for batch in text_chunks(batches):
        out = []
        for part, peek, id_, text in zip(*(batch.column(n).to_pylist() for n in ("part", "peek", "doc_id", "text"))):
            if before is not None and before[1] == part and (not peek or not before[2]):
                described = before[4]
                own = _described(text)
                out.append(_compared(before[0], before[3], described, text, own[2]))
            elif before is None or before[1] != part:
                own = _described(text)
            else:
                continue  # one row after the last is enough
            before = (id_, part, peek, text, own)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)


def _compared(id_, text: str, described: tuple, following: str, next_print: str) -> dict:
    points, prefixes, own = described
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    _, edited_prefixes, edited_print = _described(edited)
    return {
        "doc_id": id_,
        "n_chars": len(text),
        "edited_sha256": sha256(edited.encode()).hexdigest(),
        "fingerprint": own,
        "edited_fingerprint": edited_print,
        "near_edited": likeness(own, edited_print),
        "near_next": likeness(own, next_print),
        "kept_prefix": common_extension(prefixes, 0, edited_prefixes, 0),
    }


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("kept_prefix", pa.int64()),
    ]
)
RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, kept_prefix bigint"
)


def edited_fingerprints(documents: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is replaced by
    as much of the next text's beginning. ``kept_prefix`` is the longest common
    extension from both beginnings.

    The next text is by ascending id, nulls first, repeated ids by text; the first
    text follows the last. Ids are cut into ranges at quantiles; the texts move once,
    to their ranges, and the first rows of a range also to the range before it.
    """
    rows = documents.select(F.col(identity).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    # Borders come from the ids alone; they are as many as there are ranges.
    ids = rows.select("doc_id")
    ranges = max(1, min(MAX_RANGES, ids.count() // RANGE_ROWS))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    borders = ids.agg(F.percentile_approx(F.col("doc_id").cast("double"), shares, max(1000, 20 * ranges))).first()[0]
    ids, rows = _ranged(ids, borders or [0.0]), _ranged(rows, borders or [0.0])
    firsts = ids.groupBy("part").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id"))).alias("first")
    )
    firsts = sorted(firsts.collect(), key=lambda r: r["part"])
    before = {row["part"]: firsts[i - 1]["part"] for i, row in enumerate(firsts)}
    spark = documents.sparkSession
    heads = spark.createDataFrame(
        [(r["part"], before[r["part"]], r["first"]["doc_id"]) for r in firsts], "part int, previous int, head bigint"
    )
    # As many rows as there are ranges: MAX_RANGES at most.
    placed = rows.join(F.broadcast(heads), "part", "left")
    is_head = F.col("doc_id").eqNullSafe(F.col("head"))
    here = F.struct(F.col("part").alias("part"), F.lit(False).alias("peek"))
    there = F.struct(F.col("previous").alias("part"), F.lit(True).alias("peek"))
    sent = placed.withColumn("to", F.explode(F.when(is_head, F.array(here, there)).otherwise(F.array(here)))).select(
        "to.part", "to.peek", "doc_id", "text"
    )
    # One range is one task; its number is the number of the task.
    dealt = sent.repartitionById(max(r["part"] for r in firsts) + 1 if firsts else 1, "part")
    ordered = dealt.sortWithinPartitions("part", "peek", F.col("doc_id").asc_nulls_first(), "text")
    return map_batches(ordered, _with_next, RESULT).withColumnRenamed("doc_id", identity)


def _ranged(rows: DataFrame, borders: list[float]) -> DataFrame:
    """The range of each id: how many borders are not above it, nulls below all."""
    splits = [float("-inf"), *sorted(set(borders)), float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="id_as_double", outputCol="bucket", handleInvalid="keep")
    ranged = bucketizer.transform(rows.withColumn("id_as_double", F.col("doc_id").cast("double")))
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("bucket").cast("int"))
    return ranged.withColumn("part", part).drop("id_as_double", "bucket")
