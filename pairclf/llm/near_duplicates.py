"""Near duplicates by ProbMinHash.

A text is a bag of five-word shingles (lower case, split at white space; a shorter
text is one shingle), weighted by how often they occur. In the signature every
shingle sends a Poisson process of arrivals, at a rate of its weight, to random
registers; a register keeps the shingle that came first. A shingle stops when its next
arrival is later than all registers. Two registers agree with the probability Jaccard
similarity: sum over common shingles of 1 / sum over all of max(x_j / x_i, y_j / y_i).

Signatures are cut into bands. Copies are one node; each band bucket is compared with
its least node, and links are verified on the whole texts. Buckets that still hold
several components are compared in pairs of blocks, which are split over the tasks: signatures
first, most alike first, then the bags themselves, as long as two rows are not linked
by then. Only links leave a task. Classes are the components of verified links.

Null and empty texts, and rows without an id, link to nothing: their class is their
own id. An id counts as one document, also if it is repeated. Empty tables give empty
tables. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import write_table
from .common import map_batches, text_chunks, whole_text
from .components import components

WORDS = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 5
REGISTERS = BANDS * ROWS
#: Signatures agree in 0.8 of 120 registers with a deviation of 0.037; pairs that agree
#: in fewer than 0.6 are below the similarity but for one pair in ten million.
LEAST_AGREEMENT = 0.6
#: Rows and distinct shingles in a block of a bucket that is compared in pairs of blocks.
BLOCK_ROWS = 1_024
BLOCK_SHINGLES = 1_000_000

_CACHED_WORDS = 150_000


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers well mixed (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_word_hashes = _WordHashes()


def shingle_bags(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]:
    """document, shingle hash, weight of all bags, and each document's hash of words."""
    hashes: list[int] = []
    sizes, keys = [], []
    for text in texts:
        tokens = text.lower().split()
        keys.append(xxhash.xxh3_128_digest(" ".join(tokens)) if tokens else None)
        hashes.extend(map(_word_hashes.__getitem__, tokens))
        if tokens and len(tokens) < words:
            hashes.extend([0] * (words - len(tokens)))
        sizes.append(max(len(tokens), words) if tokens else 0)
    ids, counts = np.array(hashes, dtype=np.uint64), np.array(sizes, dtype=np.int64)
    if not len(ids):
        return np.zeros(0, np.int64), ids, np.zeros(0), keys
    document = np.repeat(np.arange(len(texts)), counts)
    reach = len(ids) - words + 1
    shingle = np.zeros(reach, dtype=np.uint64)
    for offset in range(words):
        shingle = mixed(shingle * np.uint64(3) + ids[offset : offset + reach])
    inside = document[:reach] == document[words - 1 :]
    document, shingle = document[:reach][inside], shingle[inside]
    order = np.lexsort((shingle, document))
    document, shingle = document[order], shingle[order]
    first = np.concatenate([[True], (document[1:] != document[:-1]) | (shingle[1:] != shingle[:-1])])
    starts = np.flatnonzero(first)
    weight = np.diff(np.append(starts, len(first))).astype(np.float64)
    return document[starts], shingle[starts], weight, keys


def signatures(count: int, document: np.ndarray, shingle: np.ndarray, weight: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The shingle in each register of each document; zeros for an empty bag."""
    times = np.full(count * registers, np.inf)
    held = np.zeros(count * registers, dtype=np.uint64)
    time, turn = np.zeros(len(shingle)), 0
    while len(shingle):
        turn += 1
        bits = mixed(shingle + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
        time = time - np.log(((bits >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / weight
        place = document * registers + ((mixed(bits) >> np.uint64(40)) % np.uint64(registers)).astype(np.int64)
        early = np.flatnonzero(time < times[place])
        np.minimum.at(times, place[early], time[early])
        won = early[time[early] == times[place[early]]]
        held[place[won]] = shingle[won]
        present = np.flatnonzero(np.bincount(document, minlength=count))
        latest = np.zeros(count)
        latest[present] = times.reshape(count, registers)[present].max(axis=1)
        alive = time < latest[document]
        document, shingle, weight, time = document[alive], shingle[alive], weight[alive], time[alive]
    return held.reshape(count, registers)


def band_keys(held: np.ndarray) -> np.ndarray:
    """One number for each band of each signature, different for different bands."""
    bands = held.reshape(len(held), BANDS, ROWS)
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(held), 1))
    for row in range(ROWS):
        keys = mixed(keys * np.uint64(3) + bands[:, :, row])
    return keys.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two weighted bags (sorted hashes, weights).

    For a common shingle with q = y / x, the others add x_j max(1, q_j / q) / x: those
    with a larger ratio count by y and the rest by x, so sums in the order of the
    ratios give all terms at once.
    """
    (hash_a, weight_a), (hash_b, weight_b) = a, b
    _, at_a, at_b = np.intersect1d(hash_a, hash_b, assume_unique=True, return_indices=True)
    if not len(at_a):
        return 0.0
    x, y = weight_a[at_a], weight_b[at_b]
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    only_a, only_b = weight_a.sum() - x.sum(), weight_b.sum() - y.sum()
    low = np.cumsum(x) + only_a  # at ratios up to this one, in units of x_i
    high = np.append(np.cumsum(y[::-1])[::-1][1:], 0.0) + only_b
    return float(np.sum(1.0 / (low / x + high / y)))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches):
        document, shingle, weight, keys = shingle_bags(batch.column("text").to_pylist())
        held = signatures(batch.num_rows, document, shingle, weight)
        bands = band_keys(held)
        offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * BANDS)
        short = (mixed(held) >> np.uint64(48)).astype(np.uint16)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node"),
                pa.array(keys, pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(bands.ravel())),
                pa.array([row.tobytes() for row in short], pa.binary()),
                pa.array(np.bincount(document, minlength=batch.num_rows).astype(np.int64)),
            ],
            names=["node", "content", "bands", "signature", "shingles"],
        )
    _word_hashes.clear()  # the worker outlives the task


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, bag_a = None, None
    for batch in text_chunks(batches, "text_b"):
        a, b = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
        keep = []
        for left, right in zip(a, b):
            if left != last:
                last, bag_a = left, shingle_bags([left])[1:3]
            keep.append(probability_jaccard(bag_a, shingle_bags([right])[1:3]) >= SIMILARITY - 1e-12)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, its sorted shingle hashes and their weights."""
    for batch in text_chunks(batches):
        document, shingle, weight, _ = shingle_bags(batch.column("text").to_pylist())
        ends = np.cumsum(np.bincount(document, minlength=batch.num_rows))
        parts = list(zip([0, *ends[:-1]], ends))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node"),
                pa.array([shingle[low:high].tobytes() for low, high in parts], pa.binary()),
                pa.array([weight[low:high].astype(np.float32).tobytes() for low, high in parts], pa.binary()),
            ],
            names=["node", "hashes", "weights"],
        )


def _link_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between rows of a cell that nothing has linked so far.

    Rows come sorted by cell; a cell has two blocks of rows at most. A pair of rows is
    looked at in the first band that it shares.
    """
    names = ["band", "low", "high", "node", "label", "block", "signature", "bands", "hashes", "weights"]
    cell, rows = None, []

    def links() -> pa.RecordBatch:
        node, label, block = (np.array([r[i] for r in rows]) for i in (3, 4, 5))
        held = np.frombuffer(b"".join(r[6] for r in rows), dtype=np.uint16).reshape(len(rows), REGISTERS)
        bands = np.array([r[7] for r in rows], dtype=np.int64)
        bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def bag(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in bags:
                bags[i] = np.frombuffer(rows[i][8], np.uint64), np.frombuffer(rows[i][9], np.float32).astype(np.float64)
            return bags[i]

        found_a, found_b = [], []
        for i in range(len(rows)):
            # In a cell of one block all pairs; else the pairs across its two blocks.
            if cell[1] == cell[2]:
                j = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
            elif block[i] == cell[1]:
                j = np.flatnonzero((block == cell[2]) & (label != label[i]))
            else:
                continue
            if not len(j):
                continue
            agreement = (held[j] == held[i]).mean(axis=1)
            near = agreement >= LEAST_AGREEMENT
            j, agreement = j[near], agreement[near]
            shared = bands[j] == bands[i]
            first = shared.argmax(axis=1) if len(j) else np.zeros(0, np.int64)
            here = bands[j, first] == cell[0]
            j, agreement = j[here], agreement[here]
            for k in j[np.argsort(-agreement, kind="stable")]:
                if label[k] != label[i] and probability_jaccard(bag(i), bag(int(k))) >= SIMILARITY - 1e-12:
                    found_a.append(min(node[i], node[k]))
                    found_b.append(max(node[i], node[k]))
                    label[label == label[k]] = label[i]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (found_a, found_b)], names=["a", "b"])

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in names)):
            if row[:3] != cell:
                if len(rows) > 1:
                    yield links()
                cell, rows = row[:3], []
            rows.append(row)
    if len(rows) > 1:
        yield links()


def near_duplicate_classes(documents: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """identity and class_id (the least id of the class), for each row of ``documents``.

    An id with several texts is one document: the classes of its texts are one class.
    """
    rows = documents.select(F.col(identity).cast("bigint").alias("node"), whole_text(text).alias("text"))
    repeated = rows.filter("node IS NOT NULL").groupBy("node").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    repeated = write_table(repeated.select("node"), "near-repeated-ids")
    classes = _classes(rows) if repeated.isEmpty() else _classes_of_ids(rows, repeated)
    return classes.select(F.col("node").alias(identity), F.col("class").alias("class_id"))


def _classes_of_ids(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """node, class: the texts of repeated ids are nodes of their own, with numbers beyond
    all ids; classes that share an id are then linked."""
    most = rows.agg(F.max("node")).first()[0]
    of_repeated = rows.join(repeated, "node", "left_semi")
    own = of_repeated.distinct().withColumn("own", F.lit(most) + 1 + F.monotonically_increasing_id())
    own = write_table(own, "near-own-nodes")
    single = rows.join(repeated, "node", "left_anti").select("node", "text")
    classes = write_table(_classes(single.unionByName(own.select(F.col("own").alias("node"), "text"))), "near-text-classes")
    members = own.select("node", "own").join(classes.select(F.col("node").alias("own"), "class"), "own").select("node", "class")
    members = write_table(members.distinct(), "near-id-classes")
    first = members.groupBy("node").agg(F.min("class").alias("a"))
    links = members.join(first, "node").filter("class <> a").select("a", F.col("class").alias("b")).distinct()
    labels = components(write_table(links, "near-id-links")).select(F.col("node").alias("class"), "label")
    grouped = members.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    # A label beyond all ids names a class of repeated ids alone.
    least = grouped.groupBy("label").agg(F.min("node").alias("least"))
    grouped = write_table(grouped.join(least, "label").withColumn("least", F.least("least", "label")), "near-id-labels")
    of_class = grouped.select("class", "least").distinct()
    kept = classes.filter(F.col("node").isNull() | (F.col("node") <= most)).join(of_class, "class", "left")
    kept = kept.select("node", F.coalesce("least", "class").alias("class"))
    of_id = grouped.groupBy("node").agg(F.min("least").alias("class"))
    return kept.unionByName(of_repeated.select("node").join(of_id, "node").select("node", "class"))


def _classes(rows: DataFrame) -> DataFrame:
    """node, class of rows (node, text); a node that is not null has one text."""
    schema = "node bigint, content binary, bands array<bigint>, signature binary, shingles bigint"
    signed = write_table(map_batches(rows, _sign, schema), "near-signatures")
    known = signed.filter("node IS NOT NULL AND content IS NOT NULL")
    # Copies are one node. The minimum is taken in every task before the shuffle.
    copies = write_table(known.groupBy("content").agg(F.min("node").alias("first")), "near-copies")
    firsts = copies.join(known, (known["node"] == copies["first"]) & (known["content"] == copies["content"])).select(
        "node", "bands", "signature", "shingles"
    )
    firsts = write_table(
        firsts.groupBy("node").agg(*[F.first(c).alias(c) for c in ("bands", "signature", "shingles")]), "near-nodes"
    )
    banded = firsts.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = write_table(buckets, "near-buckets")
    inside = write_table(banded.join(buckets, "band").filter("size > 2 OR node <> first"), "near-members")
    stars = write_table(inside.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct(), "near-stars")
    texts = _texts(rows, stars)
    links = write_table(_verified(stars, texts), "near-links")
    labels = components(links)
    # What the stars left apart: buckets of several components, in cells of two blocks.
    labelled = (
        inside.filter("size > 2")
        .join(labels, "node", "left")
        .select("band", "node", F.coalesce("label", "node").alias("label"))
    )
    labelled = write_table(labelled, "near-labelled")
    mixed_up = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    several = write_table(mixed_up.select("band"), "near-several")
    nodes = firsts.join(map_batches(texts, _bags, "node bigint, hashes binary, weights binary"), "node")
    rows_of = write_table(labelled.join(several, "band").join(firsts.select("node", "shingles"), "node"), "near-apart")
    sizes = rows_of.groupBy("band").agg(F.count(F.lit(1)).alias("rows"), F.sum("shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = write_table(sizes.select("band", blocks.alias("blocks")), "near-blocks")
    cells = (
        rows_of.select("band", "node", "label")
        .join(sizes, "band")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .join(nodes, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "node", "label", "block", "signature", "bands", "hashes", "weights",
        )
    )
    order = ["band", "low", "high"]
    more = map_batches(cells.repartition(*order).sortWithinPartitions(*order), _link_cells, "a bigint, b bigint").distinct()
    more = write_table(more, "near-more-links")
    labels = components(links.union(more)) if not more.isEmpty() else labels
    # Members of a copy take the label of its first.
    named = copies.join(labels, copies["first"] == labels["node"], "left").select("content", F.coalesce("label", "first").alias("class"))
    named = write_table(named, "near-classes")
    found = known.select("node", "content").join(named, "content").select("node", "class")
    alone = signed.filter("node IS NULL OR content IS NULL").select("node", F.col("node").alias("class"))
    return found.union(alone)


def _texts(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """node, text of the nodes in ``pairs``, written: far fewer than all as a rule."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    nodes = write_table(nodes, "near-candidates")
    return write_table(rows.join(nodes, "node").groupBy("node").agg(F.min("text").alias("text")), "near-texts")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    of_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    of_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return map_batches(pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b"), _verify, "a bigint, b bigint")
