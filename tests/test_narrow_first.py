"""The newest row is chosen on narrow rows: what is exchanged, and what comes out."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quadloom.operators import binaries, keyed, state, versions

T = datetime(2024, 5, 1)
WIDE = "identifier STRING, modified TIMESTAMP_NTZ, created TIMESTAMP_NTZ, seq BIGINT, interactionModel STRING, quads STRING"
IDS, EACH, LENGTH = 20, 40, 5_000


@pytest.fixture(params=["broadcast", "filter", "shuffle"])
def way(request, spark, monkeypatch):
    """The three ways in which chosen rows are fetched."""
    if request.param != "broadcast":
        monkeypatch.setattr(keyed, "BROADCAST_BYTES", 0)
    if request.param == "shuffle":
        monkeypatch.setattr(keyed, "FILTER_BITS", 0)
    if request.param == "filter":
        monkeypatch.setattr(keyed, "FILTER_BITS", 1 << 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def wide_rows(spark):
    """Versions with long texts that do not compress well."""
    n = F.col("id")
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(LENGTH // 40)), lambda i: F.sha1(F.concat_ws("/", n, i))), "")
    return spark.range(0, IDS * EACH, 1, 4).select(
        F.concat(F.lit("data:/r"), (n % IDS).cast("string")).alias("identifier"),
        F.timestamp_add("MINUTE", n.cast("int"), F.lit(T).cast("timestamp_ntz")).alias("modified"),
        F.timestamp_add("MINUTE", n.cast("int"), F.lit(T).cast("timestamp_ntz")).alias("created"),
        n.alias("seq"),
        F.lit("m").alias("interactionModel"),
        text.alias("quads"),
    )


def stored(spark, tmp_path):
    wide_rows(spark).write.parquet(str(tmp_path / "wide"))
    return spark.read.parquet(str(tmp_path / "wide"))


def shuffled_bytes(spark, make):
    """Bytes that making and running a DataFrame writes to shuffles, its plan, and its rows."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    none, quantiles = jvm.java.util.ArrayList(), gateway.new_array(jvm.double, 0)

    def stages():
        found = spark._jsc.sc().statusStore().stageList(none, False, False, quantiles, none)
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteBytes() for i in range(found.size())}

    before = stages()
    df = make()
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(b for s, b in stages().items() if s not in before), plan, rows


def whole_rows_compared(plan):
    return [line for line in plan.splitlines() if "SortAggregate" in line and "quads" in line]


def test_only_chosen_rows_are_exchanged(spark, tmp_path, way):
    held = stored(spark, tmp_path)
    size, plan, rows = shuffled_bytes(spark, lambda: state.newest(held, ["identifier"], state.ORDER))
    assert sorted(r.seq for r in rows) == list(range(IDS * (EACH - 1), IDS * EACH))
    assert not whole_rows_compared(plan)
    whole = IDS * EACH * LENGTH
    # a filter of a million bits lets some of the others through
    assert size < whole / 4 if way != "shuffle" else size > whole / 4


def test_versions_of_requests(spark, tmp_path, way):
    held = stored(spark, tmp_path)
    asked = spark.createDataFrame(
        [(i, f"data:/r{i % IDS}", T + timedelta(minutes=200)) for i in range(30)], "req BIGINT, identifier STRING, at TIMESTAMP_NTZ"
    )
    size, plan, rows = shuffled_bytes(spark, lambda: versions.version_rows(held, asked, ["seq", "quads"]))
    assert sorted((r.req, r.seq) for r in rows) == [(i, 180 + i % IDS if i % IDS else 200) for i in range(30)]
    assert all(len(r.quads) == LENGTH for r in rows)
    assert not whole_rows_compared(plan)
    assert way == "shuffle" or size < IDS * EACH * LENGTH / 4


def test_state_does_not_move_for_a_few_changes(spark, tmp_path):
    held = stored(spark, tmp_path).filter(F.col("seq") < 600).withColumn("identifier", F.col("seq").cast("string"))
    changes = spark.createDataFrame(
        [("5", T, T + timedelta(days=9), 1, "n", "new"), ("7", T, T - timedelta(days=9), 1, "n", "late"),
         ("7", T, T - timedelta(days=8), 1, "n", "late, too"), ("x", T, T, 1, "n", "one"), ("x", T, T, 2, "n", "two"), (None, T, T, 2, "n", "")],
        WIDE,
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    size, plan, rows = shuffled_bytes(spark, lambda: state.upsert(held, changes))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 601
    found = {r.identifier: r.quads for r in rows}
    assert (found["5"], found["x"]) == ("new", "two") and len(found["7"]) == LENGTH
    assert not whole_rows_compared(plan)
    assert size < 100_000


def test_a_log_folds_on_narrow_rows(spark, tmp_path, way):
    log = stored(spark, tmp_path).select(
        F.when(F.col("seq") % 7 == 3, "touch").when(F.col("seq") % 50 == 49, "delete").otherwise("replace").alias("op"),
        "identifier", F.col("created").alias("ts"), "seq", "quads",
    )
    size, plan, rows = shuffled_bytes(spark, lambda: state.fold_ops(log, ["quads"]))
    expected = {}
    for r in sorted(log.select("op", "identifier", "ts", "seq").collect(), key=lambda r: r.seq):
        if r.op == "replace":
            expected[r.identifier] = [r.seq, r.ts]
        elif r.op == "delete":
            expected.pop(r.identifier, None)
        elif r.identifier in expected:
            expected[r.identifier][1] = r.ts
    assert {r.identifier: [r.seq, r.modified] for r in rows} == expected
    assert not whole_rows_compared(plan)
    assert way == "shuffle" or size < IDS * EACH * LENGTH / 4


def test_ranges_move_only_what_they_ask_for(spark, tmp_path, way):
    """Binaries of 100 kB, of which 2 kB are asked for; absent ones and starts past the end are answered."""
    content = F.encode(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2_500)), lambda i: F.sha1(F.concat_ws("/", "id", i))), ""), "UTF-8")
    whole = spark.range(0, 60, 1, 3).select(F.concat(F.lit("b"), "id").alias("identifier"), content.alias("content"), F.lit(100).alias("chunkSize"))
    binaries.chunk(whole).write.parquet(str(tmp_path / "chunks"))
    whole.write.parquet(str(tmp_path / "whole"))
    chunks, whole = spark.read.parquet(str(tmp_path / "chunks")), spark.read.parquet(str(tmp_path / "whole"))
    spans = [(n, f"b{n % 60 if n % 3 else 0}", 50_000 + 777 * n % 40_000, 50_000 + 777 * n % 40_000 + 1_999) for n in range(120)]
    spans += [(500, "none", 0, 9), (501, "b1", 100_000, 100_010), (502, "b1", 99_990, 10**12), (503, "b1", 7, 6)]
    asked = spark.createDataFrame(spans, "req BIGINT, identifier STRING, `from` BIGINT, `to` BIGINT")
    held = {r.identifier: bytes(r.content) for r in whole.collect()}
    expected = {n: held[i][a : b + 1] if i in held else None for n, i, a, b in spans}
    size, plan, rows = shuffled_bytes(spark, lambda: binaries.read_range(chunks, asked))
    assert {r.req: r.content if r.content is None else bytes(r.content) for r in rows} == expected
    assert {r.req for r in rows if not r.found} == {500}
    assert size < (600_000 if way == "broadcast" else 1_500_000 if way == "filter" else 9_000_000)
    size, plan, rows = shuffled_bytes(spark, lambda: binaries.read_range_object(whole, asked))
    assert {r.req: r.content if r.content is None else bytes(r.content) for r in rows} == expected
    assert size < (600_000 if way == "broadcast" else 9_000_000)


def test_a_binary_given_twice_is_written_once(spark, way):
    schema = "identifier STRING, content BINARY, chunkSize INT, at INT"
    none = binaries.chunk(spark.createDataFrame([], schema))
    twice = spark.createDataFrame([("a", b"12345", 4, 1), ("a", b"abc", 4, 2), ("a", b"abc", 4, 2), ("b", b"", 4, 1)], schema)
    for order, contents in (([], {b"12345", b"abc"}), (["at"], {b"abc"})):
        made = binaries.read_all(binaries.set_content(none, twice, order)).collect()
        assert len(made) == 2
        assert next(bytes(r.content) for r in made if r.identifier == "a") in contents


def test_ties_nulls_and_repeated_rows(spark, way):
    rows = [
        ("a", T, None, None, "m", "1"), ("a", T, None, 5, "m", "2"),
        ("b", T, T, 1, "m", "3"), ("b", T, T, 1, "m", "3"), ("b", T, T, 1, "m", "4"),
        (None, T, T, 1, "m", "5"), (None, T, T, 2, "m", "6"),
        ("c", T, datetime(1, 1, 1), -(2**63), "m", "7"), ("c", T, datetime(9999, 12, 31), 2**63 - 1, "m", "8"), ("c", T, None, 2**63 - 1, "m", "9"),
    ]
    df = spark.createDataFrame(rows, WIDE).repartition(3)
    found = {r.identifier: r.quads for r in state.newest(df, ["identifier"], state.ORDER).collect()}
    assert found.pop("b") in ("3", "4")
    assert found == {"a": "2", None: "6", "c": "8"}
    first = {r.identifier: r.quads for r in state.newest(df, ["identifier"], state.ORDER, oldest=True).collect()}
    assert first.pop("b") in ("3", "4")
    assert first == {"a": "1", None: "5", "c": "9"}
    assert state.newest(df, ["identifier"], state.ORDER).count() == 4
    assert state.newest(df, ["identifier"], ["quads"]).count() == 4  # no key for texts
    assert state.newest(df.filter("false"), ["identifier"], state.ORDER).count() == 0


def test_order_keys_sort_like_their_columns(spark):
    random.seed(2)
    instants = [None, datetime(1, 1, 1), datetime(1969, 12, 31, 23, 59, 59, 999_999), datetime(1970, 1, 1), datetime(9999, 12, 31, 23, 59, 59, 999_999)]
    instants += [datetime(1960, 1, 1) + timedelta(microseconds=random.randrange(10**16)) for _ in range(200)]
    rows = [(i, n) for i in instants for n in random.sample([None, -(2**63), -1, 0, 1, 2**63 - 1], 2)]
    df = spark.createDataFrame(rows, "t TIMESTAMP_NTZ, n BIGINT")
    got = [tuple(r) for r in df.select("t", "n").orderBy(keyed.order_key(df, ["t", "n"])).collect()]
    assert got == sorted(rows, key=lambda r: ((r[0] is not None, r[0] or T), (r[1] is not None, r[1] or 0)))
    assert keyed.order_key(df, ["n", "t"]) is None


def test_filter_loses_nothing(spark):
    df = spark.range(5_000).select(F.col("id").cast("string").alias("identifier"), "id")
    keys = df.filter("id % 50 = 0").select("identifier")
    kept = keyed.may_match(df, keys, ["identifier"], 100_000)
    assert kept.join(keys, "identifier").count() == 100
    assert kept.count() < 250 and kept.columns == df.columns
