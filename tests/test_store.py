"""Tables at rest: what a change rewrites, what readers see, and the view that follows."""

import random
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quadloom import schemas
from quadloom import vocab as v
from quadloom.operators import keyed, resources, state
from quadloom.sources import store as store_module
from quadloom.sources.store import BucketStore
from quadloom.sources.views import ContainmentView, containment_changes

T = datetime(2024, 1, 1)
ROW = "identifier STRING, value INT, modified TIMESTAMP_NTZ, created TIMESTAMP_NTZ, seq BIGINT"
BUCKETS = 32


def table(spark, ids, value=0, seq=1):
    return spark.createDataFrame([(i, value, T, T, seq) for i in ids], ROW)


def files(root):
    return {str(p) for p in root.rglob("*.parquet") if "data" in p.parts}


def test_a_purge_rewrites_its_buckets_alone(spark, rows, tmp_path):
    store = BucketStore(spark, str(tmp_path / "s"), ROW, BUCKETS)
    assert store.version() == 0 and store.read().count() == 0
    names = [f"r{i}" for i in range(1_000)]
    assert store.replace(table(spark, names)) == 1
    before, opened = files(tmp_path), store.read()
    gone = spark.createDataFrame([(f"r{i}",) for i in range(10)] + [("absent",)], "identifier STRING")
    assert store.delete(gone) == 2
    old, new = store.manifest(1), store.manifest(2)
    changed = {b for b in old if old[b] != new.get(b)}
    assert changed <= set(store.touched(gone)) and len(changed) <= 11
    assert len({p.split("bucket=")[1].split("/")[0] for p in files(tmp_path) - before}) <= 11
    assert rows(store.read(), "identifier") == sorted((n,) for n in names[10:])
    # those who read the version before go on with it
    assert opened.count() == 1_000 and store.read(1).count() == 1_000
    assert store.delete(gone.filter("false")) == 3 and store.read().count() == 990


def test_upserts_at_rest(spark, rows, tmp_path):
    store = BucketStore(spark, str(tmp_path / "s"), ROW, BUCKETS)
    store.replace(table(spark, ["a", "b", "c"]))
    store.upsert(table(spark, ["b", "d"], 7, 2).unionByName(table(spark, ["c"], 9, 0)).unionByName(table(spark, [None], 1, 1)))
    assert rows(store.read(), "identifier", "value") == [("a", 0), ("b", 7), ("c", 0), ("d", 7)]


def test_a_failed_write_changes_nothing(spark, rows, tmp_path):
    store = BucketStore(spark, str(tmp_path / "s"), ROW, 2)
    store.replace(table(spark, ["a", "b"]))
    boom = F.when(F.col("identifier") == "a", F.raise_error(F.lit("lost"))).otherwise(F.col("value"))
    with pytest.raises(Exception, match="lost"):
        store.change(table(spark, ["a", "b"]), lambda r: r.withColumn("value", boom.cast("int")))
    assert store.version() == 1 and rows(store.read(), "identifier", "value") == [("a", 0), ("b", 0)]
    # of two writers that start from one version the later one fails
    other = BucketStore(spark, str(tmp_path / "s"), ROW, 2)
    other.version = lambda: 1
    store.delete(table(spark, ["a"]))
    with pytest.raises(Exception, match="(?i)exist"):
        other.delete(table(spark, ["b"]))
    assert rows(store.read(), "identifier") == [("b",)]


def test_expired_versions_and_an_empty_table(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "s"), ROW, 4)
    store.replace(table(spark, [f"r{i}" for i in range(20)]))
    everything = store.read().select("identifier")
    store.delete(everything)
    assert store.read().count() == 0 and store.manifest() == {}
    store.upsert(table(spark, ["x"]))
    assert store.expire(3) == 3  # two manifests and the first write; the second wrote no bucket
    assert store.version() == 3 and store.read().count() == 1
    assert len(files(tmp_path)) == 1


@pytest.mark.parametrize("way", ["broadcast", "filter", "shuffle"])
def test_kept_rows_are_written_where_they_are_read(spark, rows, tmp_path, monkeypatch, way):
    """A change moves narrow rows, its own and what may meet them; the result is that of whole rewriting."""
    if way != "broadcast":
        monkeypatch.setattr(keyed, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(keyed, "FILTER_BITS", 1 << 20 if way == "filter" else 0)
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(50)), lambda i: F.sha1(F.concat_ws("/", "id", i))), "")
    named = F.when(F.col("id") % 97 == 0, None).otherwise(F.concat(F.lit("r"), (F.col("id") % 1_500).cast("string")))
    made = spark.range(0, 2_000, 1, 4).select(
        named.alias("identifier"), F.lit(None).cast("string").alias("interactionModel"), text.alias("quads"),
        F.lit(T).cast("timestamp_ntz").alias("created"), F.col("id").alias("seq"),
    )
    store = BucketStore(spark, str(tmp_path / "s"), made.schema, 4)
    store.replace(made)
    whole = store.read(1)
    new = whole.filter("seq % 100 = 1").withColumn("interactionModel", F.lit("new")).withColumn("seq", F.col("seq") + F.when(F.col("seq") % 200 == 1, 5).otherwise(-5))
    gone = whole.filter("seq % 100 = 2").select("identifier")
    none, quantiles = spark._jvm.java.util.ArrayList(), spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = lambda: spark._jsc.sc().statusStore().stageList(none, False, False, quantiles, none)
    last = max(stages().apply(i).stageId() for i in range(stages().size()))
    store.upsert(new)
    store.delete(gone)
    seen = stages()
    moved = sum(seen.apply(i).shuffleWriteBytes() for i in range(seen.size()) if seen.apply(i).stageId() > last)
    assert way == "shuffle" or moved < 2_000 * 2_000 / 4
    assert rows(store.read()) == rows(state.delete(state.upsert(whole, new), gone))
    # one key order in each file
    at = Window.partitionBy("f").orderBy("n")
    lying = store.read().select("identifier", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n"))
    assert lying.withColumn("before", F.lag("identifier").over(at)).filter("before > identifier").count() == 0


def test_many_small_files_are_placed_anew(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "MOST_FILES", 3)
    store = BucketStore(spark, str(tmp_path / "s"), ROW, 2)
    store.replace(table(spark, [f"r{i}" for i in range(20)]))
    for n in range(8):
        store.upsert(table(spark, ["r1", "r2", "r3", "r4", f"x{n}"], n, n + 2))
        assert len(store.read().inputFiles()) <= 3 * 2 + 8
    assert rows(store.read(), "identifier") == sorted([(f"r{i}",) for i in range(20)] + [(f"x{n}",) for n in range(8)])


MODELS = [v.LDP_RDF_SOURCE, v.LDP_BASIC_CONTAINER, None]


def resource(i, container, model, n):
    return (i, model, container, None, None, T, T, n, None)


def test_the_view_equals_recomputation(spark, rows, tmp_path):
    """Moves, deletions, new resources and new models over batches, a third of all children in one container."""
    pick = random.Random(1)
    held = BucketStore(spark, str(tmp_path / "state"), schemas.RESOURCES, BUCKETS)
    view = ContainmentView(held, str(tmp_path / "view"), 16)

    def made(ids, n):
        places = ["hot/", *(f"c{k}" for k in range(12)), None]
        rows = [resource(f"r{i}", "hot/" if pick.random() < 0.33 else pick.choice(places), pick.choice(MODELS), n) for i in ids]
        return spark.createDataFrame(rows, schemas.RESOURCES)

    held.replace(made(range(400), 1))
    assert view.refresh().count() == resources.children(held.read()).count()
    for n in range(2, 5):
        held.upsert(made([*pick.sample(range(400), 3), 400 + n], n))
        if n != 3:  # a refresh that was left out is made up for
            assert view.refresh().count() <= 2 * 2 * 4 + 4
            assert rows(view.read()) == rows(resources.children(held.read()))
        held.delete(spark.createDataFrame([(f"r{i}",) for i in pick.sample(range(400), 2)], "identifier STRING"))
    view.refresh()
    assert rows(view.read()) == rows(resources.children(held.read()))
    version = view.store.version()
    assert view.refresh().count() == 0 and view.store.version() == version


def test_only_touched_buckets_of_the_view_are_written(spark, tmp_path):
    held = BucketStore(spark, str(tmp_path / "state"), schemas.RESOURCES, BUCKETS)
    view = ContainmentView(held, str(tmp_path / "view"), 64)
    held.replace(spark.createDataFrame([resource(f"r{i}", f"c{i % 200}", MODELS[0], 1) for i in range(800)], schemas.RESOURCES))
    view.refresh()
    before = view.store.manifest()
    held.upsert(spark.createDataFrame([resource("r5", "c9", MODELS[0], 2)], schemas.RESOURCES))
    changes = {(r.container, r.sign) for r in view.refresh().collect()}
    assert changes == {("c5", -1), ("c9", 1)}
    after = view.store.manifest()
    assert 1 <= sum(before[b] != after[b] for b in before) <= 2


def test_changes_of_containment(spark, rows):
    one = spark.createDataFrame([resource("a", "x", MODELS[0], 1), resource("b", "x", None, 1), resource("c", None, MODELS[0], 1)], schemas.RESOURCES)
    two = spark.createDataFrame([resource("a", "x", MODELS[1], 1), resource("b", "x", None, 1), resource("c", "y", MODELS[0], 1)], schemas.RESOURCES)
    assert rows(containment_changes(one, two), "container", "identifier", "interactionModel", "sign") == sorted(
        [("x", "a", MODELS[0], -1), ("x", "a", MODELS[1], 1), ("y", "c", MODELS[0], 1)], key=repr
    )
    assert state.delete(one, two.select("identifier")).count() == 0
