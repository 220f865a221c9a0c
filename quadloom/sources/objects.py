"""Objects under keys: whole binaries and N-Quads texts as files."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import BinaryIO

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.operators.quads import bad_lines, quads_of_lines
from quadloom.operators.state import newest
from quadloom.schemas import CHUNKS
from quadloom.vocab import DEFAULT_CHUNK_SIZE


def _key_of_path(path: Column, root: str) -> Column:
    """The part of a file's path below ``root``, whatever scheme Spark shows it with."""
    return F.substring_index(path, root.rstrip("/").split("://")[-1] + "/", -1)


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """(key, content, modified) of all files below a folder.

    The content is only read when a later step uses it.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    key = _key_of_path(F.col("path"), root)
    return files.select(key.alias("key"), "content", F.col("modificationTime").alias("modified"))


ARROW_SCHEMES = ("file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss")
# Chunks read by one row of work, when a file is read in pieces.
_RUN = 64


def chunk_files(
    spark: SparkSession, root: str, chunk_size: int = DEFAULT_CHUNK_SIZE, partitions: int | None = None,
    open_file: Callable[[str], BinaryIO] | None = None,
) -> DataFrame:
    """All files below a folder as chunks, a file's key being its identifier.

    Files may be of any size, also beyond what one value can hold: they are
    listed without their content, and ranges of each are read by many tasks.
    Spark has no reader for ranges of a file, so those tasks read with Arrow.
    The number of them is fixed, as what they are given is too small for Spark
    to tell how much they will read.

    Without ``open_file`` the folder must be a plain path or one with a scheme
    in ``ARROW_SCHEMES``, whose clients and credentials Arrow has of its own;
    others fail here, before any task. ``open_file(path)`` gives a seekable
    binary file in a task for any other store.
    """
    scheme = root.split("://")[0].split(":/")[0] if ":/" in root else "file"
    if open_file is None and scheme not in ARROW_SCHEMES:
        raise ValueError(f"Arrow reads no files of scheme {scheme!r}: give open_file")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    last = F.floor(F.col("length") / chunk_size).cast("bigint")
    runs = files.select(
        _key_of_path(F.col("path"), root).alias("identifier"),
        "path",
        F.col("length").alias("size"),
        last.alias("last"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(_RUN).cast("bigint"))).alias("first"),
    )
    tasks = partitions or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    spread = runs.repartition(tasks, "path", "first")
    return spread.mapInArrow(_range_reader(chunk_size, _RUN, open_file), CHUNKS)


def _range_reader(chunk_size: int, run: int, open_file: Callable[[str], BinaryIO] | None):
    """Rows (identifier, path, size, last, first) to the chunks of the run each names."""

    def read(batches):
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        def by_arrow(name):
            uri = re.sub(r"^file:/+", "file:///", quote(name, safe=":/@"))
            system, path = fs.FileSystem.from_uri(uri)
            return system.open_input_file(path)

        for batch in batches:
            for row in batch.to_pylist():
                with (open_file or by_arrow)(row["path"]) as file:
                    for index in range(row["first"], min(row["first"] + run - 1, row["last"]) + 1):
                        file.seek(index * chunk_size)
                        chunk = file.read(max(min(chunk_size, row["size"] - index * chunk_size), 0))
                        yield pa.RecordBatch.from_pydict(
                            {
                                "identifier": pa.array([row["identifier"]], pa.string()),
                                "size": pa.array([row["size"]], pa.int64()),
                                "chunkSize": pa.array([chunk_size], pa.int32()),
                                "chunkIndex": pa.array([index], pa.int32()),
                                "chunk": pa.array([chunk], pa.binary()),
                            }
                        )

    return read


def write_objects(objects: DataFrame, path: str) -> None:
    """Append objects (key, content, mimeType, put) to a table of objects.

    ``put`` orders the puts of a key: a number of the write, or an instant.
    """
    objects.select("key", "content", "mimeType", "put").write.mode("append").parquet(path)


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """The table of objects with the last put of each key only: one row a key.

    The choice is made on keys and ``put``; contents are fetched for it. Of
    several puts alike in ``put`` the one stays whose content has the least hash.
    """
    return newest(spark.read.parquet(path), ["key"], ["put"])


def compact_objects(spark: SparkSession, path: str, compacted: str) -> None:
    """Write what ``read_objects`` gives to another path, ready to be appended to: old puts are left behind."""
    read_objects(spark, path).write.parquet(compacted)


def nquads_lines(spark: SparkSession, root: str) -> DataFrame:
    """(identifier, line) of N-Quads files, which may be split between tasks.

    The identifier is the file's key, as a graph's blank nodes are its file's own.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(root)
    # This path is shown URL-encoded, but for the plus sign, which stands for itself.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    key = _key_of_path(path, root)
    return lines.select(key.alias("identifier"), F.col("value").alias("line"))


def read_nquads(spark: SparkSession, root: str) -> DataFrame:
    return quads_of_lines(nquads_lines(spark, root))


def read_bad_lines(spark: SparkSession, root: str) -> DataFrame:
    return bad_lines(nquads_lines(spark, root))


def write_nquads(lines: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write a table of (identifier, line) as N-Quads files, sorted within each.

    Rows are ranged over both columns: one resource may fill several files.
    """
    by = ["identifier", "line"]
    ranged = lines.repartitionByRange(partitions, *by) if partitions else lines.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).select("line").write.mode("errorifexists").text(path)
