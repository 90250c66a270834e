"""Fill-in-middle transformation: a text is cut at two units and its parts are dealt anew.

A text lies in fixed blocks of its UTF-8 bytes. A Fenwick tree holds, for each block, how
many units begin in it and how many code points; descending it by powers of two finds
the block in which a given unit begins, with the units and code points before that
block, and the place inside the block is then found among its own bytes.

Units are code points, words (with the white space after them; white space before the
first word is a unit of its own) or lines (with their line end). Of the SHA-256 of
``seed:id`` the first four groups of 8 hexadecimal digits are h1 to h4: with n units the
prefix has the smaller of h1 % (n + 1) and h2 % (n + 1) units, prefix and middle together
the larger. With h3 % 100 from ``100 - plain_percent`` on the text stays plain, as do an
empty text and one that holds a mark; else h4 % 100 below ``suffix_first_percent`` puts
the suffix first. The output is

    psm: <P> prefix <S> suffix <M> middle        spm: <S> suffix <P> prefix <M> middle

A null text counts as empty and a null id as an empty one, so all rows without an id have
the same h1 to h4. Equal rows give equal rows; nothing is shuffled, and no row depends on
another one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_batches, text_chunks, whole_text

#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
#: Bytes of a block.
BLOCK = 1024
#: The white space that ends words: fixed values.
SPACES = b" \t\n\x0b\x0c\r"


class BlockTree:
    """Fenwick tree over the blocks of one text, with two sums: units and code points."""

    def __init__(self, units: Sequence[int], points: Sequence[int]):
        self.size = len(units)
        self.units, self.points = [0, *units], [0, *points]
        for place in range(1, self.size + 1):
            above = place + (place & -place)
            if above <= self.size:
                self.units[above] += self.units[place]
                self.points[above] += self.points[place]
        self.top = 1 << self.size.bit_length() >> 1

    def find(self, unit: int) -> tuple[int, int, int]:
        """The block in which the unit (from 0) begins, and the units and code points
        before that block; the number of blocks when there are not as many units."""
        block, left, points, step = 0, unit, 0, self.top
        while step:
            reached = block + step
            if reached <= self.size and self.units[reached] <= left:
                block = reached
                left -= self.units[reached]
                points += self.points[reached]
            step >>= 1
        return block, unit - left, points

    def total(self) -> tuple[int, int]:
        """Units and code points of the whole text."""
        units = points = 0
        place = self.size
        while place:
            units += self.units[place]
            points += self.points[place]
            place &= place - 1
        return units, points


def point_starts(data: np.ndarray) -> np.ndarray:
    """The bytes with which a code point begins."""
    return (data & 0xC0) != 0x80


def unit_starts(data: np.ndarray, starts: np.ndarray, points: np.ndarray, unit: str) -> np.ndarray:
    """The bytes with which a unit begins, in texts that begin at ``starts``."""
    if unit == "character":
        return points
    begins = np.zeros(len(data), dtype=bool)
    if unit == "word":
        space = np.isin(data, np.frombuffer(SPACES, dtype=np.uint8))
        begins[1:] = space[:-1] & ~space[1:]
    elif unit == "line":
        begins[1:] = data[:-1] == ord("\n")
    else:
        raise ValueError(f"units are character, word or line, not {unit}")
    begins[starts[starts < len(data)]] = True
    return begins


class CutText:
    """One text in blocks: where its units begin, in bytes and in code points."""

    def __init__(self, units: np.ndarray, points: np.ndarray):
        self.is_unit, self.is_point = units, points
        if len(units):
            edges = np.arange(0, len(units), BLOCK)
            by_point = np.add.reduceat(points, edges, dtype=np.int64).tolist()
            by_unit = by_point if units is points else np.add.reduceat(units, edges, dtype=np.int64).tolist()
        else:
            by_unit = by_point = []
        self.tree = BlockTree(by_unit, by_point)

    def place(self, unit: int) -> tuple[int, int]:
        """Byte and code point at which the unit begins; the end after the last one."""
        block, units, points = self.tree.find(unit)
        if block == self.tree.size:
            return len(self.is_unit), points
        start = block * BLOCK
        local = int(np.flatnonzero(self.is_unit[start : start + BLOCK])[unit - units])
        return start + local, points + int(np.count_nonzero(self.is_point[start : start + local]))


def _transform(unit: str, plain_percent: int, suffix_first_percent: int, marks: tuple[str, str, str]):
    """The work of a task; the last two columns of its batches are hash and text."""
    prefix_mark, suffix_mark, middle_mark = (mark.encode() for mark in marks)
    holds_mark = re.compile(b"|".join(re.escape(mark.encode()) for mark in marks)).search

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            raw = batch.column("text").cast(pa.binary())
            offsets = np.frombuffer(raw.buffers()[1], dtype=np.int32, count=len(raw) + raw.offset + 1)[raw.offset :]
            whole = np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
            edges = (offsets - offsets[0]).tolist()
            points = point_starts(whole)
            units = unit_starts(whole, np.array(edges[:-1]), points, unit)
            rows = []
            for row, digest in enumerate(batch.column("hash").to_pylist()):
                start, stop = edges[row], edges[row + 1]
                text = whole[start:stop].tobytes()
                of_units = units[start:stop]
                cut = CutText(of_units, of_units if units is points else points[start:stop])
                n, _ = cut.tree.total()
                h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
                if not text or h3 % 100 >= 100 - plain_percent or holds_mark(text):
                    rows.append((n, "plain", None, None, text))
                    continue
                first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
                (a, a_points), (b, b_points) = cut.place(first), cut.place(second)
                prefix, middle, suffix = text[:a], text[a:b], text[b:]
                if h4 % 100 < suffix_first_percent:
                    form, parts = "spm", (suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle)
                else:
                    form, parts = "psm", (prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle)
                rows.append((n, form, a_points, b_points - a_points, b"".join(parts)))
            n, form, prefix_chars, middle_chars, output = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-2],
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix_chars, pa.int64()),
                    pa.array(middle_chars, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                names=[*batch.schema.names[:-2], *OUTPUT],
            )

    return work


OUTPUT = ("n", "form", "prefix_chars", "middle_chars", "output")


def check_marks(marks: Sequence[str]) -> None:
    """Marks must tell the parts apart: none may be found inside or across two others."""
    if len(set(marks)) != 3 or not all(marks):
        raise ValueError("three different marks are needed")
    for one, other in product(marks, marks):
        if one != other and one in other:
            raise ValueError(f"the mark {other} holds the mark {one}")
        if any(one.endswith(other[:size]) for size in range(1, min(len(one), len(other)))):
            raise ValueError(f"the mark {other} begins as {one} ends")


def fill_in_middle(
    documents: DataFrame,
    unit: str = "character",
    plain_percent: int = 10,
    suffix_first_percent: int = 20,
    seed: str = "1",
    marks: tuple[str, str, str] = MARKS,
    identity: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` and, per row, n (units of the text), form (plain, psm or spm), prefix_chars
    and middle_chars (code points; null if plain) and the output text."""
    check_marks(marks)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(identity).cast("string"), F.lit("")))
    rows = documents.select(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.sha2(name, 256).alias("hash"), whole_text(text).alias("text")
    )
    kept = "".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}, " for i in range(len(keep)))
    schema = f"{kept}n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    cut = map_batches(rows, _transform(unit, plain_percent, suffix_first_percent, marks), schema)
    return cut.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *OUTPUT)


def restored(form: str = "form", output: str = "output", marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    check_marks(marks)
    any_mark = "|".join(rf"\Q{mark}\E" for mark in marks)
    parts = F.split(output, any_mark, 4)

    def joined(*order: int) -> Column:
        return F.concat(*[F.get(parts, F.lit(i)) for i in order])

    return F.when(F.col(form) == "psm", joined(1, 3, 2)).when(F.col(form) == "spm", joined(2, 3, 1)).otherwise(F.col(output))
