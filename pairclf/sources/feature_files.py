"""Feature files: one text file per image, the class in the file name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.names import label_from_file_name
from ..functions.vectors import last_line, parse_vector

FEATURE_SCHEMA = "label string, features array<double>, images string"


def scan_feature_files(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(images, value)`` per file of the directory, not recursive.

    Spark packs small files into scan partitions by itself, and gives their names
    URL-encoded. Names that begin with ``_`` or ``.`` it takes for hidden files: those
    are listed and read by tasks of their own.
    """
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    seen = spark.read.text(path, wholetext=True).select(name.alias("images"), "value")
    return seen.unionByName(_hidden_files(spark, path))


def _hidden_files(spark: SparkSession, path: str) -> DataFrame:
    """``(images, value)`` of the files that Spark's own readers leave out by name. A task
    reads the hidden files of its own slice of the listing."""
    entries, open_path = _entries(), _file_system()

    def read(batches):
        import pyarrow as pa

        files, root = open_path(path)
        for names, sizes in entries(path, batches, hidden_only=True):
            for name, size in zip(names, sizes):
                if not size:
                    continue
                with files.open_input_stream(f"{root}/{name}") as file:
                    text = file.read().decode("utf-8", "replace")
                yield pa.RecordBatch.from_pydict({"images": pa.array([name]), "value": pa.array([text], pa.string())})

    return _slices(spark).mapInArrow(read, "images string, value string")


def parse_feature_records(records: DataFrame, strict: bool = False) -> DataFrame:
    """Feature table of ``(images, value)`` records, from files or a packed table.

    Files with no line are left to :func:`reject_records`; ``strict`` raises on them.
    """
    line = last_line(F.col("value"))
    if strict:
        line = F.when(
            line.isNull(), F.raise_error(F.concat(F.lit("empty feature file: "), F.col("images"))).cast("string")
        ).otherwise(line)
    lines = records.select("images", line.alias("line"))
    return lines.filter(F.col("line").isNotNull()).select(
        label_from_file_name(F.col("images")).alias("label"),
        parse_vector(F.col("line")).alias("features"),
        "images",
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(images, size)`` of all files of the directory, hidden ones too, without reading
    one. Every task lists its own slice of the names."""
    entries = _entries()

    def listed(batches):
        import pyarrow as pa

        for names, sizes in entries(path, batches):
            yield pa.RecordBatch.from_pydict({"images": pa.array(names, pa.string()), "size": pa.array(sizes, pa.int64())})

    return _slices(spark).mapInArrow(listed, "images string, size bigint")


def _slices(spark: SparkSession) -> DataFrame:
    """One row and one task per slice of a listing: its number and how many there are."""
    slices = max(1, spark.sparkContext.defaultParallelism)
    return spark.range(0, slices, 1, slices).select("id", F.lit(slices).alias("slices"))


def _entries():
    """The function (path, batches of slices) -> lists of names and sizes of the files in
    the slices. Made here so that it travels with the functions that run in the tasks.

    Names are dealt to slices by a hash. On a mounted file system they are streamed, and
    only files of the slice are looked at, so a task holds a thousand names whatever the
    size of the directory. Other file systems hand out a listing at once.
    """
    open_path = _file_system()

    def names_of(path):
        """Pairs of a name and the function that gives its size, or None for no file."""
        import os

        from pyarrow import fs

        files, root = open_path(path)
        if isinstance(files, fs.LocalFileSystem):
            with os.scandir(root) as found:
                for entry in found:
                    yield entry.name, lambda entry=entry: entry.stat().st_size if entry.is_file() else None
        else:
            for info in files.get_file_info(fs.FileSelector(root)):
                yield info.base_name, lambda info=info: info.size if info.type == fs.FileType.File else None

    def entries(path, batches, hidden_only=False):
        from zlib import crc32

        for batch in batches:
            for own, slices in zip(batch.column("id").to_pylist(), batch.column("slices").to_pylist()):
                names, sizes = [], []
                for name, size_of in names_of(path):
                    if crc32(name.encode("utf-8", "surrogateescape")) % slices != own or (hidden_only and name[:1] not in ("_", ".")):
                        continue
                    size = size_of()
                    if size is None:
                        continue
                    names.append(name)
                    sizes.append(size)
                    if len(names) == 1000:
                        yield names, sizes
                        names, sizes = [], []
                if names:
                    yield names, sizes

    return entries


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """Names of the files without any byte, which Spark's own readers pass over."""
    return list_files(spark, path).filter("size = 0").select("images")


def reject_records(records: DataFrame) -> DataFrame:
    """The records that hold no vector."""
    return records.filter(last_line(F.col("value")).isNull()).select(
        "images", F.lit("empty file").alias("reason")
    )


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The files of the directory that hold no vector: blank ones and empty ones."""
    empty = empty_files(spark, path).withColumn("reason", F.lit("empty file"))
    return reject_records(scan_feature_files(spark, path)).unionByName(empty)


def read_feature_files(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Feature table of a directory; ``strict`` raises when a file holds no vector."""
    if strict:
        empty = empty_files(spark, path).first()
        if empty is not None:
            raise ValueError(f"empty feature file: {empty['images']}")
    return parse_feature_records(scan_feature_files(spark, path), strict)


def feature_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Feature table of a few in-memory rows, with a declared schema."""
    return spark.createDataFrame(list(rows), FEATURE_SCHEMA)


def two_sources(main: DataFrame, second: DataFrame) -> DataFrame:
    """Bag union of both feature sources, told apart by ``source``."""
    return main.withColumn("source", F.lit("main")).unionByName(
        second.withColumn("source", F.lit("all"))
    )


def write_feature_files(records: DataFrame, path: str) -> int:
    """Write ``(images, value)`` records as one file per image; returns the count.

    Each task writes the files of its own rows through the file system of the
    path, so a repeated task only writes the same content again.
    """
    open_path = _file_system()

    def write(batches):
        import pyarrow as pa

        files, root = open_path(path)
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_output_stream(f"{root}/{name}") as out:
                    out.write(value.encode())
            yield pa.RecordBatch.from_pydict({"written": [batch.num_rows]})

    files, root = open_path(path)
    files.create_dir(root, recursive=True)
    counts = records.select("images", "value").mapInArrow(write, "written bigint")
    return counts.agg(F.coalesce(F.sum("written"), F.lit(0))).first()[0]


def _file_system():
    """The function path -> (file system, path inside it), for driver and tasks."""

    def open_path(path):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")

    return open_path
