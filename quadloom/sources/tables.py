"""Tables hashed by key: into bucket folders, with their key lookups, and into buckets of a catalog.

Rows of a key are in one bucket folder, in files sorted by key. A lookup names
its buckets, which lets Spark skip all other folders, and the file statistics
of sorted keys let it skip most row groups of the ones it opens for one key.

A table saved in buckets (``save_bucketed``) is known to the catalog as hashed
and sorted, so joins and groupings on its key read it as it lies: no row of it
is shuffled or sorted again, only what it meets is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.operators.keyed import BROADCAST_BYTES, ROW_BYTES, distinct_keys, total_bytes

BUCKET = "bucket"
# Keys listed in a scan's own filter, by which it skips parts of files; Spark lists no more by default.
LISTED_KEYS = 10
# Bytes of rows that one bucket of a catalog's table, and so one task of its readers, is to hold.
BUCKET_BYTES = 64 * 1024 * 1024


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    buckets: int,
    key: str = "identifier",
    order: Sequence[str] = (),
    partitions: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write ``df`` in bucket folders, sorted by key and ``order``.

    Rows are ranged over (bucket, key, order), so a bucket or a key with a
    large share of all rows is written by several tasks into several files.
    These hold Bloom filters of keys, by which a scan for a few keys skips
    parts that have none of them.
    """
    by = [BUCKET, key, *order]
    placed = df.withColumn(BUCKET, bucket_of(key, buckets))
    ranged = placed.repartitionByRange(partitions, *by) if partitions else placed.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.option(f"parquet.bloom.filter.enabled#{key}", "true").mode(mode).partitionBy(BUCKET).parquet(path)


def rows_of_keys(
    table: DataFrame, ids: DataFrame, buckets: int, key: str = "identifier", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of a bucketed table whose key is in ``ids``, opening only their buckets.

    A first job measures the keys and tells their buckets, a number each. Keys
    of no more than ``broadcast_bytes`` are then broadcast, which moves no row
    of the table; more are joined by a shuffle.
    """
    asked = distinct_keys(ids, key).withColumn(BUCKET, bucket_of(key, buckets))
    sizes = asked.groupBy(BUCKET).agg(F.sum(F.octet_length(key)).alias("bytes"), F.count("*").alias("keys")).collect()
    kept = table.filter(F.col(BUCKET).isin([s[BUCKET] for s in sizes]))
    if 0 < sum(s["keys"] for s in sizes) <= LISTED_KEYS:
        kept = kept.filter(F.col(key).isin([r[key] for r in asked.collect()]))
    if sum(s["bytes"] + ROW_BYTES * s["keys"] for s in sizes) <= broadcast_bytes:
        asked = F.broadcast(asked)
    return kept.join(asked, [BUCKET, key], "left_semi")


def row_of_key(table: DataFrame, value: str, buckets: int, key: str = "identifier") -> DataFrame:
    """Rows of one key; both conditions reach the scan."""
    placed = bucket_of(F.lit(value), buckets)
    return table.filter((F.col(BUCKET) == placed) & (F.col(key) == value))


def buckets_for(*frames: DataFrame, least: int = 1, bucket_bytes: int | None = None) -> int:
    """So many buckets that those of the largest of ``frames`` hold about ``bucket_bytes`` (by default ``BUCKET_BYTES``).

    Tables that are to be joined as they lie need one number of buckets, and a
    task reads a whole bucket: the number grows with the rows, not the tasks'
    memory. A job for each frame measures it.
    """
    most = max(df.agg(total_bytes(df).alias("bytes")).first()["bytes"] for df in frames)
    return max(least, -(-most // (bucket_bytes or BUCKET_BYTES)))


def save_bucketed(df: DataFrame, path: str, buckets: int, by: Sequence[str] = ("identifier",), order: Sequence[str] = ()) -> DataFrame:
    """``df`` saved below ``path`` in buckets by the columns ``by``, one sorted file each, as a table of the catalog.

    A bucket is one task of whoever reads it, so all rows of one ``by`` must be
    few: an identifier, where rows are unique; else with it a part that tells a
    hot identifier's rows apart, such as a span of time or a run of chunks.
    """
    placed = df.repartition(buckets, *by)
    name = f"quadloom_{uuid.uuid4().hex}"
    writer = placed.write.bucketBy(buckets, *by).sortBy(*by, *order).option("path", path).mode("errorifexists")
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(
    spark: SparkSession, path: str, buckets: int, by: Sequence[str] = ("identifier",), order: Sequence[str] = ()
) -> DataFrame:
    """A table that ``save_bucketed`` left below ``path``, made known to this session's catalog."""
    name = f"quadloom_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    keys, sorts = (", ".join(f"`{c}`" for c in names) for names in (by, [*by, *order]))
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({sorts}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)
