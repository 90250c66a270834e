"""Filter interaction audit: what each of some filters removes, in every order of them.

Every text gets a mask with one bit for each filter that it fails. Four filters look at
the text alone; the fifth removes copies: texts that a row with a smaller id has, too.

Copies are found by radix tries. Ranges of texts are cut by prefixes that are as long as
need be: bytes are counted by prefix, and a prefix that holds more than a range should is
counted again by longer ones, until no prefix is too heavy or it is a whole text. The
counts are then cut, in order, into ranges of about ``RANGE_BYTES``. Every range is one
task, which inserts whole texts into a compressed trie (an edge is labelled by a span of
the text) whose terminals hold the least id: a row of another id is a copy as soon as its
id or a smaller one is known, and a traversal at the end releases the rows of the least
ids. Before the shuffle each task replaces the rows of one text in a batch by those of
its least id, so that a text with any number of copies is sent a few times only.

The masks are then reduced: rows are counted by part and mask, at most 32 masks a part,
and a filter's results in an order depend on nothing but which filters came before it.

Null texts are empty, null parts are the empty text. A row without an id is neither a copy
nor copied, as its id is not larger or smaller than others. Equal rows (id and text) are
no copies of each other, but all are counted. Several labels of an id count as one that
has the greatest of each mark; ids without labels, and null marks, count as 0.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import permutations
from zlib import crc32

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import write_table
from .common import map_batches, whole_text

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
#: Bytes of text that one range, hence one trie, should hold.
RANGE_BYTES = 64 << 20
#: Bytes that all borders of ranges may take, as every task gets them; beyond it ranges grow.
BORDER_BYTES = 64 << 20
#: Code points of the first prefixes; heavy ones are counted again by four times as many.
PREFIX = 16

UPPER = bytes(range(ord("A"), ord("Z") + 1))
SIGNS = b"#$%&*|"


def text_mask(raw: bytes, points: int) -> int:
    """The bits of the filters that look at the text alone: under 200 words, under half of
    the words distinct, over 2 % capital letters, any of six signs."""
    words = raw.split()
    return (
        (len(words) < 200)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * (len(raw) - len(raw.translate(None, UPPER))) > 2 * points) << 2
        | (len(raw.translate(None, SIGNS)) < len(raw)) << 3
    )


# ---------------------------------------------------------------- the trie


class Node:
    """An edge with its label, and what hangs below it."""

    __slots__ = ("label", "children", "least", "rows")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.least: int | None = None
        self.rows: Counter | None = None


class RadixTrie:
    """A compressed trie of texts; a terminal holds the least id of its text, and how many
    rows of each kind have that id."""

    def __init__(self):
        self.root = Node(b"")

    def terminal(self, text: bytes) -> Node:
        """The node at which the text ends; made if it is not there."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                return child
            if text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            same = _agree(child.label, text, at)
            upper = node.children[text[at]] = Node(child.label[:same])
            child.label = child.label[same:]
            upper.children[child.label[0]] = child
            node, at = upper, at + same
        return node

    def insert(self, text: bytes, identity: int, kind, count: int) -> Iterator[tuple[int, object, int]]:
        """Insert rows of one text, id and kind; yields (id, kind, count) of the rows that
        are copies for certain."""
        node = self.terminal(text)
        if node.least is None or identity < node.least:
            for earlier, rows in (node.rows or {}).items():
                yield node.least, earlier, rows
            node.least, node.rows = identity, Counter({kind: count})
        elif identity == node.least:
            node.rows[kind] += count
        else:
            yield identity, kind, count

    def traverse(self) -> Iterator[tuple[int, object, int]]:
        """(id, kind, count) of the rows that hold the least id of their text."""
        held = [self.root]
        while held:
            node = held.pop()
            held.extend(node.children.values())
            if node.least is not None:
                for kind, count in node.rows.items():
                    yield node.least, kind, count


def _agree(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of the label agree with the text from ``at`` on, by halving."""
    low, high = 0, len(label)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


# ---------------------------------------------------------------- ranges of texts


def prefix_weights(texts: DataFrame, range_bytes: int, first: int = PREFIX) -> DataFrame:
    """Bytes by adaptive prefix: no prefix holds more than ``range_bytes`` but a whole text.

    A heavy prefix is replaced by longer ones, counted among its own rows alone. At most
    as many prefixes are heavy as ranges fit into the table.
    """
    rows = texts.select("text", F.octet_length("text").cast("bigint").alias("_bytes"))
    size, light = first, None
    while True:
        prefix = F.substring("text", 1, size)
        weights = rows.groupBy(prefix.alias("prefix")).agg(F.sum("_bytes").alias("weight"))
        weights = write_table(weights, "prefix-weights")
        heavy = (F.col("weight") > range_bytes) & (F.char_length("prefix") == size)
        parts = weights.filter(~heavy)
        light = parts if light is None else light.unionByName(parts)
        again = write_table(weights.filter(heavy).select(F.col("prefix").alias("_heavy")), "heavy-prefixes")
        if again.isEmpty():
            return light
        rows = rows.join(again, prefix == F.col("_heavy"), "left_semi")
        size *= 4


def range_borders(weights: DataFrame, range_bytes: int, border_bytes: int = BORDER_BYTES) -> list[bytes]:
    """The least prefix of every range but the first, in order.

    Prefixes are sorted over all tasks and written; a prefix lies in the range that its
    bytes and those before it fall into. One row per sort partition and range is gathered.
    """
    placed = write_table(weights.orderBy("prefix").withColumn("_place", F.monotonically_increasing_id()), "prefixes-in-order")
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    of_part = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_part").agg(F.sum("weight").alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.coalesce(F.sum("weight").over(of_part), F.lit(0))
    ordered = placed.join(sums, "_part").select("prefix", place.alias("place"))
    while True:
        least = ordered.groupBy(F.floor(F.col("place") / range_bytes).alias("number")).agg(F.min("prefix").alias("prefix"))
        least = write_table(least.filter("number > 0"), "range-borders")
        if least.agg(F.coalesce(F.sum(F.octet_length("prefix") + 64), F.lit(0))).first()[0] <= border_bytes:
            return sorted(row["prefix"].encode() for row in least.select("prefix").toLocalIterator())
        range_bytes *= 2


# ---------------------------------------------------------------- masks


def filter_masks(
    documents: DataFrame,
    part: Column,
    identity: str = "doc_id",
    text: str = "text",
    range_bytes: int = RANGE_BYTES,
    prefix: int = PREFIX,
) -> DataFrame:
    """doc_id, part, mask and how many rows (``rows``) have them."""
    documents = documents.select(
        F.col(identity).cast("bigint").alias("doc_id"),
        F.coalesce(part.cast("string"), F.lit("")).alias("part"),
        whole_text(text).alias("text"),
    )
    borders = range_borders(prefix_weights(documents.select("text"), range_bytes, prefix), range_bytes)
    shared = documents.sparkSession.sparkContext.broadcast(borders)
    sent = map_batches(
        documents, _mask_and_send(shared), "range int, doc_id bigint, part string, mask int, rows bigint, text binary"
    )
    dealt = sent.repartitionById(len(borders) + 1, "range").select("doc_id", "part", "mask", "rows", "text")
    masks = map_batches(dealt, _tries, "doc_id bigint, part string, mask int, rows bigint")
    return masks.groupBy("doc_id", "part", "mask").agg(F.sum("rows").alias("rows"))


def _mask_and_send(shared):
    """Masks of the texts, and of each batch one row for every text's least id, with its
    range. Rows whose last bit is known travel without their text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = shared.value
        for batch in batches:
            least: dict[bytes, int] = {}
            masks: dict[bytes, int] = {}
            counts: Counter = Counter()
            texts = batch.column("text")
            points = pc.utf8_length(texts).to_pylist()
            rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), texts.cast(pa.binary()).to_pylist()))
            for size, (name, part, text) in zip(points, rows):
                if text not in masks:
                    masks[text] = text_mask(text, size)
                if name is not None:
                    least[text] = min(name, least.get(text, name))
                counts[name, part, text] += 1
            places, names, parts, of_rows, sizes, sent = [], [], [], [], [], []
            for (name, part, text), count in counts.items():
                mask = masks[text]
                open_yet = name is not None and name == least[text]
                if name is not None and not open_yet:
                    mask |= COPY
                places.append(bisect_right(borders, text) if open_yet else crc32(text) % (len(borders) + 1))
                names.append(name)
                parts.append(part)
                of_rows.append(mask)
                sizes.append(count)
                sent.append(text if open_yet else None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(places, pa.int32()), pa.array(names, pa.int64()), pa.array(parts, pa.string()),
                    pa.array(of_rows, pa.int32()), pa.array(sizes, pa.int64()), pa.array(sent, pa.binary()),
                ],
                names=["range", "doc_id", "part", "mask", "rows", "text"],
            )

    return work


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of one range; gives masks with the last bit known."""

    def made(rows: list[tuple[int | None, str, int, int]]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[], [], [], []]
        types = (pa.int64(), pa.string(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "part", "mask", "rows"])

    trie = RadixTrie()
    for batch in batches:
        known = []
        for name, part, mask, rows, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "mask", "rows", "text"))):
            if text is None:
                known.append((name, part, mask, rows))
                continue
            for least, (of_part, of_mask), count in trie.insert(text, name, (part, mask), rows):
                known.append((least, of_part, of_mask | COPY, count))
        yield made(known)
    known = []
    for least, (part, mask), count in trie.traverse():
        known.append((least, part, mask, count))
        if len(known) == 10_000:
            yield made(known)
            known = []
    yield made(known)


# ---------------------------------------------------------------- orders


def filter_orders(masks: DataFrame, labels: DataFrame, identity: str = "doc_id") -> DataFrame:
    """One row per part, order of the filters and step, with the counts of that step.

    ``masks`` is what :func:`filter_masks` gives, ``labels`` has quality and toxic by id.
    """
    marked = labels.groupBy(F.col(identity).cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("bigint")).alias("good"), F.max((F.col("toxic") == 1).cast("bigint")).alias("toxic")
    )
    # Ids that are marked at all; the join moves ids and masks, no text.
    marked = marked.filter("good = 1 OR toxic = 1").filter("doc_id IS NOT NULL")
    rows = masks.join(marked, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("rows").alias("n"),
        F.sum(F.col("rows") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("rows") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    after = masks.sparkSession.createDataFrame(_steps(), "before int, bit int, filter_order string, step int")
    steps = F.array(*[F.struct(F.lit(b).alias("before"), F.lit(f).alias("bit")) for b, f in sorted({step[:2] for step in _steps()})])
    each = rows.withColumn("_step", F.explode(steps)).select("part", "mask", "n", "good", "toxic", "_step.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    reached = F.col("mask").bitwiseAND(F.col("before")) == 0

    def total(condition: Column, column: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(F.lit(0))).cast("bigint")

    sums = each.groupBy("part", "before", "bit").agg(
        total(reached & ~fails).alias("kept"),
        total(reached & fails).alias("removed"),
        total(~reached & fails).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(reached & fails, "good").alias("good_lost"),
        total(reached & fails, "toxic").alias("toxic_lost"),
    )
    counted = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    # 600 rows, whatever the input.
    every = sums.join(F.broadcast(after), ["before", "bit"])
    removed_at_all = every.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return every.join(removed_at_all, ["part", "bit"]).select("part", "filter_order", "step", *counted, "shapley")


def _steps() -> list[tuple[int, int, str, int]]:
    """(bits before, bit, order, step) of every step of every order."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, start=1):
            bit = 1 << FILTERS.index(letter)
            steps.append((before, bit, "".join(order), step))
            before |= bit
    return steps


def filter_audit(documents: DataFrame, labels: DataFrame, part: Column) -> DataFrame:
    """The audit of whole documents; see :func:`filter_masks` and :func:`filter_orders`."""
    return filter_orders(write_table(filter_masks(documents, part), "filter-masks"), labels)
