"""Tables saved in buckets are read as they lie."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quadloom import schemas
from quadloom import vocab as v
from quadloom.operators import binaries, keyed, resources, versions
from quadloom.plans import catalog
from quadloom.sources import tables

T = datetime(2024, 1, 1)
BUCKETS = 8


@pytest.fixture
def large(spark, monkeypatch):
    """Nothing is small enough to be broadcast."""
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", 0)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, value in settings.items():
        spark.conf.set(k, value)
    yield spark
    for k in settings:
        spark.conf.unset(k)


def ways_up(df, mark):
    """For each scan whose line has ``mark``: the operators above it, up to the first join or grouping."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    found = []
    for i, line in enumerate(lines):
        if "FileScan" in line and mark in line:
            way, at = [], depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < at:
                    at = depth[j]
                    way.append(lines[j].strip(" :+-*()0123456789").split(" ")[0].split("(")[0])
                    if "Join" in way[-1] or "Aggregate" in way[-1]:
                        break
            found.append(way)
    return found


def test_assemble_moves_nothing_of_stored_tables(large, rows, tmp_path):
    n = 400
    state = [
        (f"data:/r{i}", v.LDP_RDF_SOURCE if i % 4 else v.LDP_BASIC_CONTAINER, f"data:/r{i // 40 * 4}", None, None, T, T, i, f"<s> <p> <o{i}> .")
        for i in range(n)
    ]
    added = [(f"data:/r{i % n}", T, f"<a> <p> <o{i}> .") for i in range(900)]
    state, added = large.createDataFrame(state, schemas.RESOURCES), large.createDataFrame(added, schemas.IMMUTABLE)
    asked = large.createDataFrame([(f"data:/r{i}",) for i in range(0, 600, 3)], "identifier STRING")
    saved = [tables.save_bucketed(df, str(tmp_path / name), BUCKETS) for df, name in ((state, "state"), (added, "added"))]
    df = resources.assemble(*saved, asked)
    assert rows(df) == rows(resources.assemble(state, added, asked))
    ways = ways_up(resources.assemble(*saved, asked), "identifier#")
    stored = [w for w in ways_up(df, "Bucketed: true")]
    assert len(ways) >= len(stored) >= 2
    assert all("Exchange" not in w for w in stored), stored
    again = tables.open_bucketed(large, str(tmp_path / "state"), BUCKETS)
    assert rows(again) == rows(saved[0])
    met = again.join(asked, "identifier", "left_semi")
    assert all("Exchange" not in w for w in ways_up(met, "Bucketed: true")) and met.count() == 134


def test_buckets_grow_with_the_rows_and_not_with_a_task(spark, monkeypatch, tmp_path):
    few, many = (spark.range(n).selectExpr("concat('data:/r', id) identifier", "repeat('x', 100) quads") for n in (50, 4_000))
    monkeypatch.setattr(tables, "BUCKET_BYTES", 16_384)
    assert tables.buckets_for(few, least=BUCKETS) == BUCKETS
    n = tables.buckets_for(few, many, least=BUCKETS)
    assert n == tables.buckets_for(many) > 4 * BUCKETS
    saved = tables.save_bucketed(many, str(tmp_path / "many"), n)
    in_buckets = saved.groupBy(F.input_file_name()).agg(keyed.total_bytes(saved).alias("b"))
    assert in_buckets.agg(F.max("b")).first()[0] < 2 * tables.BUCKET_BYTES


def test_stored_queries_save_as_many_buckets_as_their_rows_need(spark, monkeypatch):
    """The queries' own tables: with a bound far below them they are saved in more than the least number of buckets."""
    used = []
    monkeypatch.setattr(tables, "BUCKET_BYTES", 4_096)
    monkeypatch.setattr(catalog.tables, "save_bucketed", lambda df, path, buckets, **_: used.append(buckets) or df)
    monkeypatch.setattr(catalog.resources, "assemble", lambda *frames: frames)
    text, number, at = "concat('t', id) {0}", "id {0}", "timestamp_ntz'2024-01-01 00:00:00' {0}"
    columns = {
        "region": [(number, "r_regionkey")],
        "nation": [(number, "n_nationkey"), (number, "n_regionkey")],
        "customer": [(number, "c_custkey"), (number, "c_nationkey"), (text, "c_mktsegment")],
        "orders": [(number, "o_orderkey"), (number, "o_custkey"), (text, "o_orderstatus"), (text, "o_orderpriority"), (at, "o_orderdate")],
        "documents": [(number, "doc_id"), (text, "text"), (text, "lang")],
        "lineitem": [(number, "l_orderkey"), (number, "l_linenumber"), (at, "l_shipdate")],
        "part": [(number, "p_partkey")],
    }
    made = {name: spark.range(300).selectExpr(*(how.format(c) for how, c in given)) for name, given in columns.items()}
    monkeypatch.setattr(catalog.fx, "table", lambda spark, sf_dir, name: made[name])
    catalog.assemble_stored(spark, "")
    assert len(used) == 2 and used[0] == used[1] > BUCKETS


@pytest.mark.parametrize("bits", [1 << 20, 2_000, 0])
def test_texts_move_as_quads_only(large, rows, monkeypatch, bits):
    """Beyond a broadcast, what is asked for is told by a filter; what that lets through wrongly is taken out."""
    n = 400
    state = [
        (None if i == 9 else f"data:/r{i % 390}", v.LDP_RDF_SOURCE if i % 4 else v.LDP_BASIC_CONTAINER, f"data:/r{i // 40 * 4}", None, None, T, T, i, f"<s> <p> <o{i}> .")
        for i in range(n)
    ]
    added = [(None if i == 5 else f"data:/r{i % n}", T, f"<a> <p> <o{i}> .") for i in range(900)]
    state, added = large.createDataFrame(state, schemas.RESOURCES), large.createDataFrame(added, schemas.IMMUTABLE)
    asked = large.createDataFrame([(f"data:/r{i}",) for i in range(0, 600, 3)] + [(None,)], "identifier STRING")
    got = {}
    for name, ids in (("some", asked), ("all", None)):
        monkeypatch.setattr(keyed, "BROADCAST_BYTES", 1 << 20)
        got[name] = rows(resources.assemble(state, added, ids))
        monkeypatch.setattr(keyed, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(keyed, "FILTER_BITS", bits)
        monkeypatch.setattr(keyed, "BITS_PER_KEY", 1)
        df = resources.assemble(state, added, ids)
        assert rows(df) == got[name] and len(got[name]) > 300
        if bits == 1 << 20:
            monkeypatch.setattr(keyed, "BROADCAST_BYTES", 1 << 20)
            held = keyed.picked(asked.filter("identifier IS NOT NULL").distinct(), "held")
            monkeypatch.setattr(keyed, "BROADCAST_BYTES", 10_000)
            assert not held.small and rows(held.met(added)) == rows(added.join(asked, "identifier", "left_semi"))
            plan = held.met(added)._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(identifier" not in plan and "SortMergeJoin" not in plan


def test_objects_of_versions_are_made_by_many_tasks(spark, rows, monkeypatch, tmp_path):
    """However few files the events are in."""
    path = str(tmp_path / "events")
    spark.range(2_000).selectExpr("id event_id", "id % 7 user_id", "'click' event_type", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) ts").coalesce(1).write.parquet(path)
    monkeypatch.setattr(catalog.fx, "table", lambda spark, sf_dir, name: spark.read.parquet(path))
    monkeypatch.setattr(catalog.fx, "requests", lambda spark, sf_dir: None)
    monkeypatch.setattr(catalog, "work_folder", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(catalog.versions, "version_quads", lambda held, *_, **__: held)
    held = catalog.version_quads_objects(spark, "")
    assert held.count() == 2_000
    assert len(list((tmp_path / "versions").glob("*.parquet"))) > spark.sparkContext.defaultParallelism
    assert rows(catalog.fx.versions(spark, "")) == rows(catalog.fx.versions(spark, "", spread=True))


def test_as_of_moves_nothing_of_stored_versions(large, rows, tmp_path):
    pick = random.Random(3)
    spans = 1_000
    held = [(f"data:/r{min(pick.randrange(30), 12)}", T + timedelta(seconds=pick.randrange(40 * spans))) for _ in range(3_000)]
    asked = [(i, f"data:/r{pick.randrange(15)}", T + timedelta(seconds=pick.randrange(-5 * spans, 60 * spans))) for i in range(300)]
    held = large.createDataFrame(held, "identifier STRING, modified TIMESTAMP_NTZ")
    asked = large.createDataFrame(asked, schemas.REQUESTS)
    timed = versions.with_span(held, bucket_seconds=spans)
    saved = tables.save_bucketed(timed, str(tmp_path / "v"), BUCKETS, by=("identifier", "span"), order=["t"])
    got = versions.version_at_stored(saved, asked, bucket_seconds=spans)
    assert rows(got) == rows(versions.version_at(held, asked))
    ways = ways_up(got, "Bucketed: true")
    assert len(ways) >= 2 and all("Exchange" not in w for w in ways), ways


def test_a_scan_for_a_few_keys_skips_parts_of_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(40_000).select(F.sha1(F.col("id").cast("string")).alias("identifier"), "id")
    tables.write_table(df, path, 1, partitions=1)
    table = tables.read_table(spark, path)
    for asked, listed in ((3, True), (tables.LISTED_KEYS + 1, False)):
        found = tables.rows_of_keys(table, df.limit(asked), 1)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("In(identifier" in plan or "identifier IN" in plan) == listed
        assert found.count() == asked


def test_versions_are_listed_by_stem(spark, rows, tmp_path):
    keyed_ = v.Settings(version_key_prefix="m/")
    objects = spark.createDataFrame(
        [(f"m/r{i}?version={n}",) for i in range(50) for n in range(20)] + [("m/r1?version",), ("m/r1?version=x",), ("m/r1/sub?version=3",), ("m/other",)],
        "key STRING",
    )
    path = str(tmp_path / "o")
    tables.write_table(versions.by_stem(objects), path, 16, key="stem", order=["key"])
    stored = tables.read_table(spark, path)
    asked = spark.createDataFrame([("data:/r1",), ("data:/r7",), ("data:/none",), (None,)], "identifier STRING")
    got = versions.catalog_of(stored, asked, 16, keyed_)
    wanted = versions.catalog(objects, keyed_).join(asked, "identifier", "left_semi")
    assert rows(got) == rows(wanted) and got.count() == 40
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "In(stem" in plan


def test_stored_lengths_and_digests_spare_the_content(spark, rows, tmp_path):
    whole = spark.createDataFrame([("a", b"x" * 37, 4), ("b", b"", 4)], "identifier STRING, content BINARY, chunkSize INT")
    binaries.with_digests(binaries.chunk(whole)).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    for make in (binaries.audit, binaries.digest, binaries.missing_chunks):
        assert rows(make(stored)) == rows(make(binaries.chunk(whole)))
        plan = make(stored)._jdf.queryExecution().executedPlan().toString()
        assert not any("chunk:binary" in x for x in plan.split("ReadSchema: ")[1:])
