"""Local sessions for tests and the benchmark, and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quadloom")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder: ``spark.checkpoint.dir``, else ``spark.sql.warehouse.dir``.

    Both are folders that the driver and all executors share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/quadloom-work/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """``df`` written to a work folder, by folders of the columns ``partitions``, and read from there."""
    path = work_folder(df.sparkSession, name)
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_with(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``df`` written once to a work folder and read from there, and aggregates of it taken while it was written."""
    seen = Observation()
    columns = [column.alias(measure) for measure, column in measures.items()]
    return written(df.observe(seen, *columns), name), seen.get
