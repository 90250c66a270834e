"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that are worked on at once in Python.
CHUNK_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_bucket(column: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % buckets


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for an application, so that the work of
    tasks can import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Only the driver reads this file; Spark serves its copy to the executors.
    path = os.path.join(tempfile.mkdtemp(prefix="pairclf-code-"), "pairclf_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, files in os.walk(top):
            for name in sorted(files):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Memory that Arrow and the C library hold for later goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries have none
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Run ``work`` over the Arrow batches of every partition, where they lie."""
    ship_package(df.sparkSession)

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Workers outlive their tasks, and those of an executor share its memory with the
        # JVM; what Arrow holds back goes to the system after each batch of results, and what
        # the C library holds back at the end of a task.
        try:
            for batch in work(batches):
                yield batch
                del batch
                pa.default_memory_pool().release_unused()
        finally:
            give_back()

    return df.mapInArrow(released, schema)


def text_chunks(batches: Iterable[pa.RecordBatch], column: str = "text", chars: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``chars`` characters each, one row at
    least, so that a batch of very long texts is not worked on at once."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for row, length in enumerate(lengths):
            held += length or 0
            if held >= chars:
                yield batch.slice(start, row + 1 - start)
                start, held = row + 1, 0
        if start < len(lengths):
            yield batch.slice(start)
        del batch  # not held while the next one is read
