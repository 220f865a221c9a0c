"""A third of all rows under one key: joins on it are divided, and nothing is lost."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quadloom import schemas
from quadloom import vocab as v
from quadloom.operators import binaries, keyed, quads, resources, versions

T = datetime(2024, 1, 1)
N = 30_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skewed(spark, monkeypatch):
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", 0)
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, value in SETTINGS.items():
        spark.conf.set(k, value)
    yield spark
    for k, value in before.items():
        spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def hot_ids(spark, prefix="data:/r"):
    """Row n of N is of one resource where n is a multiple of 3, else of its own."""
    n = F.col("id")
    own = F.concat(F.lit(prefix), n.cast("string"))
    hot = F.when(n % 3 == 0, F.lit(prefix + "0")).otherwise(own)
    return spark.range(0, N, 1, 12).select(n, hot.alias("identifier"))


def run(df):
    """Row count, and how many joins were divided."""
    count = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return count, plan.count("SortMergeJoin(skew=true)")


def distinct_rows(spark, prefix="data:/r"):
    own = F.concat(F.lit(prefix), F.col("id").cast("string"))
    return spark.range(0, N, 1, 12).select(own.alias("identifier"), "id")


def state_rows(spark):
    values = {
        "interactionModel": F.lit(v.LDP_CONTAINER),
        "modified": F.lit(T).cast("timestamp_ntz"),
        "created": F.lit(T).cast("timestamp_ntz"),
        "seq": F.col("id"),
    }
    names = [c.split()[0] for c in schemas.RESOURCES.split(", ")][1:]
    empty = spark.createDataFrame([], schemas.RESOURCES).schema
    columns = [values.get(c, F.lit(None)).cast(empty[c].dataType).alias(c) for c in names]
    return distinct_rows(spark).select("identifier", *columns)


def test_lookup(skewed):
    count, divided = run(resources.lookup(hot_ids(skewed), state_rows(skewed)))
    assert count == N and divided == 1


def test_immutable_quads(skewed):
    line = F.concat(F.lit("<s> <p> <o"), F.col("id").cast("string"), F.lit("> ."))
    immutable = hot_ids(skewed).select("identifier", F.lit(T).alias("created"), line.alias("quads"))
    count, divided = run(resources.immutable_quads(immutable, hot_ids(skewed)))
    assert count == N and divided == 1


def test_assemble_a_hot_container(skewed):
    tree = state_rows(skewed).withColumn(
        "container", F.when(F.col("seq") % 3 == 0, F.lit("data:/r0")).otherwise(F.col("identifier"))
    )
    none = skewed.createDataFrame([], schemas.IMMUTABLE)
    count, divided = run(resources.assemble(tree, none))
    assert count == 2 * N and divided >= 1


def test_version_quads_of_a_hot_version(skewed):
    names = [c.split()[0] for c in schemas.VERSIONS.split(", ")]
    held = distinct_rows(skewed).select(
        "identifier",
        F.lit(T).cast("timestamp_ntz").alias("modified"),
        F.lit(T).cast("timestamp_ntz").alias("created"),
        F.col("id").alias("seq"),
        F.lit(v.LDP_RDF_SOURCE).alias("interactionModel"),
        F.lit("<s> <p> <o> .").alias("quads"),
        *[F.lit(None).alias(c) for c in names if c in ("container",)],
    )
    asked = hot_ids(skewed).select(F.col("id").alias("req"), "identifier", F.lit(T + timedelta(seconds=9)).cast("timestamp_ntz").alias("at"))
    count, divided = run(versions.version_at(held, asked))
    assert count == N and divided == 1
    count, divided = run(versions.version_quads(held, asked))
    assert count == 2 * N and divided == 2


def test_ranges_of_a_hot_binary(skewed):
    held = distinct_rows(skewed, "b").select("identifier", F.encode("identifier", "UTF-8").alias("content"), F.lit(4).alias("chunkSize"))
    asked = hot_ids(skewed, "b").select(F.col("id").alias("req"), "identifier", F.lit(0).cast("bigint").alias("from"), F.lit(9).cast("bigint").alias("to"))
    df = binaries.read_range(binaries.chunk(held), asked)
    count, divided = run(df)
    assert count == N and divided == 1  # requests met the layout of chunks in a job before
    assert df.filter("content = encode(identifier, 'UTF-8')").count() == N


def test_purge_of_a_hot_binary(skewed):
    chunks = hot_ids(skewed, "b").select(
        "identifier", F.lit(1).alias("chunkSize"), F.col("id").cast("int").alias("chunkIndex"), F.lit(b"x").alias("chunk")
    )
    count, divided = run(binaries.purge(chunks, hot_ids(skewed, "b").filter("id % 3 = 1")))
    assert count == N - N // 3 and divided == 1


def test_emit_of_a_hot_resource(skewed):
    rows = hot_ids(skewed).select(
        "identifier",
        F.lit(None).cast("string").alias("graph"),
        F.lit("<s>").alias("subject"),
        F.lit("<p>").alias("predicate"),
        F.concat(F.lit("<o"), F.col("id").cast("string"), F.lit(">")).alias("object"),
    )
    out = quads.emit(rows, hot_ids(skewed), part_bytes=1_000)
    sizes = out.select("identifier", F.size(F.split("quads", "\n")).alias("n"))
    assert sizes.agg(F.sum("n")).first()[0] == N
    assert sizes.agg(F.max("n")).first()[0] < 200


def test_few_keys_move_no_row_of_a_wide_table(spark):
    chunks = hot_ids(spark, "b").select(
        "identifier", F.lit(1).alias("chunkSize"), F.col("id").cast("int").alias("chunkIndex"), F.lit(b"x").alias("chunk")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = binaries.purge(chunks, hot_ids(spark, "b").filter("id < 2"))
    plan = left._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert left.count() == N - N // 3 - 1
