"""Tables of files read as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stream_table(spark: SparkSession, path: str, files_per_trigger: int = 1_000) -> DataFrame:
    """A Parquet table as a stream, be it a folder of files or one file.

    The last letter becomes a pattern, because a stream takes a plain path for
    a folder.
    """
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")
