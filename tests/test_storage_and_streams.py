from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quadloom import schemas, session
from quadloom.operators import binaries, quads, state
from quadloom.sources import objects, tables
from quadloom.sources.oplog import OpLog
from quadloom.streaming import notifications, ops
from quadloom.streaming.sources import stream_table
from test_state_and_versions import OPS, fold, random_ops

T = datetime(2024, 1, 1)


def test_bucketed_tables_split_hot_keys_and_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("identifier"),
        F.col("id").alias("n"),
    )
    tables.write_table(df, path, buckets=4, order=["n"], partitions=12)
    table = tables.read_table(spark, path)
    assert table.drop("bucket").exceptAll(df).count() == 0 and table.count() == 3_000
    hot_files = table.filter("identifier = 'hot'").select(F.input_file_name()).distinct().count()
    assert hot_files > 1
    ids = spark.createDataFrame([("hot",), ("k1",), ("none",)], "identifier STRING")
    for limit, join in ((tables.BROADCAST_BYTES, "BroadcastHashJoin"), (10, "SortMergeJoin")):
        found = tables.rows_of_keys(table, ids, 4, broadcast_bytes=limit)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert join in plan and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert found.count() == 1_001
    assert tables.rows_of_keys(table, ids.filter("false"), 4).count() == 0
    one = tables.row_of_key(table, "k1", 4)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(identifier,k1)" in plan
    assert [r.n for r in one.collect()] == [1]


def test_files_of_quads(spark, rows, tmp_path):
    folder = tmp_path / "in"
    (folder / "a").mkdir(parents=True)
    (folder / "a" / "x.nq").write_bytes('<s> <p> "é" .\r\n# note\r\nbad\r\n'.encode())
    (folder / "y +%41.nq").write_text("<s> <p> <o> <g> .\n")
    root = str(folder)
    assert rows(objects.read_nquads(spark, root)) == [
        ("a/x.nq", None, "<s>", "<p>", '"é"'),
        ("y +%41.nq", "<g>", "<s>", "<p>", "<o>"),
    ]
    assert rows(objects.read_bad_lines(spark, root)) == [("a/x.nq", "bad")]
    read = objects.read_files(spark, root)
    assert rows(read, "key", F.length("content")) == [("a/x.nq", (folder / "a" / "x.nq").stat().st_size), ("y +%41.nq", 18)]
    out = str(tmp_path / "out")
    lines = objects.read_nquads(spark, root).withColumn("line", quads.nq.quad_line())
    objects.write_nquads(lines.select("identifier", "line"), out)
    assert {r.value for r in spark.read.text(out).collect()} == {"<s> <p> <o> <g> .", '<s> <p> "é" .'}


@pytest.mark.parametrize("run", [1, 3, 64])
def test_files_are_chunked_like_values(spark, rows, tmp_path, monkeypatch, run):
    monkeypatch.setattr(objects, "_RUN", run)
    for n in (0, 3, 4, 41):
        (tmp_path / f"f {n}+%41").write_bytes(bytes(range(n)))
    root = str(tmp_path)
    got = objects.chunk_files(spark, root, 4)
    values = objects.read_files(spark, root).select(F.col("key").alias("identifier"), "content", F.lit(4).alias("chunkSize"))
    assert rows(got) == rows(binaries.chunk(values))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("FileScan")[-1].split("ReadSchema")[-1]


def test_a_second_put_replaces(spark, rows, tmp_path):
    for n, content in enumerate((b"1", b"2")):
        df = spark.createDataFrame([("k", content, None)], schemas.BINARY_OBJECTS)
        objects.write_objects(df.withColumn("put", F.lit(n)), str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2
    assert rows(objects.read_objects(spark, str(tmp_path / "o")), "key", "content") == [("k", b"2")]


def test_puts_alike_in_order_leave_one_row(spark, rows, tmp_path):
    df = spark.createDataFrame([("k", b"1", None, 5), ("k", b"2", None, 5), ("k", b"2", None, 5), ("j", b"", "t", 1)], schemas.BINARY_OBJECTS + ", put INT")
    objects.write_objects(df.repartition(2), str(tmp_path / "o"))
    once = rows(objects.read_objects(spark, str(tmp_path / "o")))
    assert [r[0] for r in once] == ["j", "k"]
    objects.compact_objects(spark, str(tmp_path / "o"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2 and rows(objects.read_objects(spark, str(tmp_path / "c"))) == once


def test_files_of_unknown_stores_fail_before_any_task(spark, tmp_path):
    with pytest.raises(ValueError, match="open_file"):
        objects.chunk_files(spark, "odd://store/x", 4)
    (tmp_path / "f").write_bytes(b"12345")
    opened = objects.chunk_files(spark, str(tmp_path), 4, open_file=lambda path: open(path.removeprefix("file:"), "rb"))
    assert sorted(bytes(r.chunk) for r in opened.collect()) == [b"1234", b"5"]


def test_the_log_survives_repeats_and_compaction(spark, rows, tmp_path):
    all_ops = random_ops(600, seed=5)
    log = OpLog(spark, str(tmp_path / "log"), ["value"])
    for batch in range(6):
        part = all_ops[batch::6]
        log.append(spark.createDataFrame(part, OPS), batch)
        log.append(spark.createDataFrame(part, OPS), batch)
        if batch in (1, 3):
            log.compact(batch)
    want = sorted(fold(all_ops), key=repr)
    assert rows(log.current()) == want
    log.compact(3)  # saved already
    # A snapshot that was not finished is not used.
    spark.createDataFrame([(1,)], "x INT").write.parquet(str(tmp_path / "log" / "snapshot" / "through=5"))
    assert rows(log.current()) == want
    log.compact(5)
    assert rows(log.current()) == want
    assert rows(state.live(log.accumulated(1), ["value"])) == sorted(fold(all_ops[0::6] + all_ops[1::6]), key=repr)


@pytest.mark.parametrize("compact_every", [None, 2])
def test_streamed_ops_equal_the_batch_fold(spark, rows, tmp_path, compact_every):
    all_ops = random_ops(500, seed=6)
    source = str(tmp_path / "source")
    spark.createDataFrame(all_ops, OPS).repartition(5).write.parquet(source)
    log = OpLog(spark, str(tmp_path / "log"), ["value"])
    stream = stream_table(spark, source, files_per_trigger=1)
    ops.append_ops(stream, log, str(tmp_path / "check"), compact_every).awaitTermination()
    assert log.ops().select("batch").distinct().count() == 5
    assert rows(log.current()) == sorted(fold(all_ops), key=repr)
    # Started again, it has nothing to do.
    ops.append_ops(stream, log, str(tmp_path / "check"), compact_every).awaitTermination()
    assert rows(log.current()) == sorted(fold(all_ops), key=repr)


def note(n, created, id="x"):
    return (id and f"{id}{n}", "data:/a", ["agent"], ["create"], ["type"], created)


def notes_stream(spark, tmp_path, rows_, files=1):
    path = str(tmp_path / "notes")
    for n in range(files):
        spark.createDataFrame(rows_[n::files], schemas.NOTIFICATIONS).coalesce(1).write.mode("append").parquet(path)
    return stream_table(spark, path, files_per_trigger=1)


def test_notifications_are_published(spark, rows, tmp_path):
    stream = notes_stream(spark, tmp_path, [note(1, T), note(2, T, id=None), note(2, T)], files=3)
    out = str(tmp_path / "out")

    def refuse_two(id_, message):
        if id_ == "x2":
            raise OSError("no " * 1000)

    notifications.emit(stream, out, str(tmp_path / "c"), notifications.per_message(refuse_two)).awaitTermination()
    message = (
        '{"id":"x1","object":"data:/a","agents":["agent"],"types":["create"],'
        '"objectTypes":["type"],"created":"2024-01-01T00:00:00Z"}'
    )
    found = spark.read.parquet(out)
    assert rows(found.filter("reason IS NULL"), "id", "message") == [("x1", message)]
    # One message fails with its whole reason, and its batch goes on.
    assert rows(found.filter("reason IS NOT NULL"), "id", "reason") == [("x2", "no " * 1000), (None, "null notification")]
    assert found.select("batch").distinct().count() == 3


def test_a_failing_publisher_does_not_end_the_stream(spark, rows, tmp_path):
    stream = notes_stream(spark, tmp_path, [note(1, T)])

    def publish(messages):
        raise OSError("no topic")

    job = notifications.emit(stream, str(tmp_path / "out"), str(tmp_path / "c"), publish)
    job.awaitTermination()
    assert job.exception() is None
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id", "reason") == [("x1", "no topic")]


def test_dedup_keeps_one_of_each_id_in_any_order_of_time(spark, tmp_path):
    # Five batches, the copies of an id in different ones and days apart.
    sent = [note(n % 41, T + timedelta(days=(n * 7) % 41)) for n in range(123)] + [note(0, T, id=None)] * 2
    out = str(tmp_path / "out")
    stream = notes_stream(spark, tmp_path, sent, files=5)
    notifications.dedup(stream, out, str(tmp_path / "c")).awaitTermination()
    got = [r.id for r in spark.read.parquet(out).collect()]
    assert sorted(x for x in got if x) == sorted({f"x{n}" for n in range(41)}) and got.count(None) == 2


def test_a_batch_of_the_dedup_reads_nothing_of_earlier_ones(spark, tmp_path):
    """Twenty batches of new ids, started twice: state grows, what a batch reads does not; then copies of all come."""
    out, source, checkpoint = str(tmp_path / "out"), tmp_path / "in", str(tmp_path / "c")
    read = []
    for start in (0, 10):
        for n in range(start, start + 10):
            rows = [note(n * 50 + i, T) for i in range(50)]
            spark.createDataFrame(rows, schemas.NOTIFICATIONS).coalesce(1).write.mode("append").parquet(str(source))
        stream = stream_table(spark, str(source), files_per_trigger=1)
        query = notifications.dedup(stream, out, checkpoint)
        query.awaitTermination()
        read += [(p.numInputRows, p.stateOperators[0].numRowsTotal) for p in query.recentProgress if p.numInputRows]
    assert [s for _, s in read] == [50 * (n + 1) for n in range(20)]
    assert len({rows for rows, _ in read}) == 1
    assert spark.read.parquet(out).count() == 1_000
    again = spark.createDataFrame([note(i, T) for i in range(1_000)], schemas.NOTIFICATIONS)
    again.coalesce(1).write.mode("append").parquet(str(source))
    notifications.dedup(stream_table(spark, str(source), files_per_trigger=1), out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 1_000
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_work_folder_is_shared_and_new(spark, monkeypatch):
    a, b = session.work_folder(spark, "x"), session.work_folder(spark, "x")
    assert a != b
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or a.startswith(base)
