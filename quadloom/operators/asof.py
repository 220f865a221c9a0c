"""As-of matching of requested instants to version instants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadloom.operators.keyed import per_key, rows_with_keys

# About twelve days, so at most about a million narrow rows are sorted together.
BUCKET_SECONDS = 1_048_576


def resolve(versions: DataFrame, requests: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """For each distinct (identifier, t) asked: the version that stood then.

    Both inputs have identifier and ``t``, whole seconds as BIGINT. The answer
    is the latest version at or before ``t``, else the earliest of all, else
    null: (identifier, t, version_t).

    Equal points are merged before anything is sorted, so one bucket of one
    identifier holds at most ``bucket_seconds`` rows however many versions and
    requests fall into it. Buckets are sorted on their own; what earlier
    buckets hold reaches later ones through one summary row per bucket, of
    which an identifier has as many as its time span has buckets: some 3,000 in
    a century.
    """
    marked = (
        versions.select("identifier", "t", F.lit(1).alias("v"), F.lit(0).alias("r"))
        .unionAll(requests.select("identifier", "t", F.lit(0).alias("v"), F.lit(1).alias("r")))
        .withColumn("bucket", F.floor(F.col("t") / bucket_seconds))
        .filter(F.col("identifier").isNotNull() & F.col("bucket").isNotNull())
    )
    points = per_key(marked, ["identifier", "bucket", "t"], v=F.max("v"), r=F.max("r"))
    points = points.withColumn("vt", F.when(F.col("v") == 1, F.col("t")))
    within = (
        Window.partitionBy("identifier", "bucket").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    )
    asked = points.withColumn("same_bucket", F.max("vt").over(within)).filter("r = 1")

    # This branch keeps ``r`` and the same filters as the one above, so that both
    # read one shuffle of the points.
    earlier = Window.partitionBy("identifier").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        points.groupBy("identifier", "bucket")
        .agg(F.min("vt").alias("low"), F.max("vt").alias("high"), F.max("r").alias("r"))
        .select(
            "identifier",
            "bucket",
            "r",
            F.max("high").over(earlier).alias("before"),
            F.min("low").over(Window.partitionBy("identifier")).alias("earliest"),
        )
        .filter("r = 1")
        .drop("r")
    )
    return asked.join(summary, ["identifier", "bucket"]).select(
        "identifier", "t", F.coalesce("same_bucket", "before", "earliest").alias("version_t")
    )


def span_of(t: Column | str, bucket_seconds: int = BUCKET_SECONDS) -> Column:
    """The span of time that a second lies in; with the identifier, what stored versions are bucketed by."""
    return F.floor((F.col(t) if isinstance(t, str) else t) / bucket_seconds)


def reduced(versions: DataFrame, requests: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """The (identifier, t) of stored versions that ``resolve`` can need for ``requests``.

    ``versions`` has identifier, span and t, ``requests`` identifier and t.
    These are all versions of spans in which something is asked, and the first
    and last of every other span of the same identifiers. A table saved in
    buckets by (identifier, span) is read as it lies; no row of it moves
    before it is picked.
    """
    asked = requests.select("identifier", span_of("t", bucket_seconds).alias("span")).distinct()
    near = rows_with_keys(versions.select("identifier", "span", "t"), asked, keys=("identifier", "span"))
    ends = versions.groupBy("identifier", "span").agg(F.min("t").alias("low"), F.max("t").alias("high"))
    ends = rows_with_keys(ends, asked)
    far = ends.select("identifier", F.explode(F.array("low", "high")).alias("t"))
    return near.select("identifier", "t").unionByName(far)
