import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quadloom import schemas
from quadloom import vocab as v
from quadloom.operators import asof, state, versions
from quadloom.vocab import Settings

T = datetime(2024, 1, 1, 12, 0, 0, 250_000)
OPS = schemas.OPS + ", value INT"
STATE = "identifier STRING, value INT, modified TIMESTAMP_NTZ, created TIMESTAMP_NTZ, seq BIGINT"


def at(seconds):
    return T + timedelta(seconds=seconds)


def fold(ops):
    """The same by applying op after op."""
    now = {}
    for op, i, ts, seq, value in sorted(ops, key=lambda o: (o[2], o[3])):
        if op in ("create", "replace"):
            now[i] = (i, value, ts, ts, seq)
        elif op == "delete":
            now.pop(i, None)
        elif op == "touch" and i in now:
            now[i] = (*now[i][:2], ts, *now[i][3:])
    return sorted(now.values())


def random_ops(n=3_000, seed=7):
    pick = random.Random(seed)
    kinds = ["create", "replace", "touch", "touch", "delete", "add"]
    ids = ["hot"] * 20 + [f"r{i}" for i in range(40)]
    return [(pick.choice(kinds), pick.choice(ids), at(pick.randrange(500)), n, pick.choice([n, None])) for n in range(n)]


def test_fold_equals_op_after_op(spark, rows):
    ops = random_ops()
    df = spark.createDataFrame(ops, OPS)
    assert rows(state.fold_ops(df, ["value"])) == sorted(fold(ops), key=repr)
    shuffled = df.unionAll(df.limit(500)).repartition(7, "value")
    assert rows(state.fold_ops(shuffled, ["value"])) == sorted(fold(ops), key=repr)


def test_accumulated_logs_combine_in_any_order(spark, rows):
    ops = random_ops(seed=8)
    df = spark.createDataFrame(ops, OPS)
    parts = [state.accumulate(df.filter(F.col("seq") % 3 == k), ["value"]) for k in (2, 0, 1)]
    assert rows(state.live(state.combine(*parts), ["value"])) == sorted(fold(ops), key=repr)


def test_upsert_delete_touch(spark, rows):
    before = spark.createDataFrame([("a", 1, T, T, 1), ("b", 2, T, T, 1)], STATE)
    changes = spark.createDataFrame([("a", None, at(5), at(5), 2), ("c", 3, T, T, 1)], STATE)
    after = state.upsert(before, changes)
    assert rows(after, "identifier", "value") == [("a", None), ("b", 2), ("c", 3)]
    gone = spark.createDataFrame([("b",), ("x",)], "identifier STRING")
    assert rows(state.delete(after, gone), "identifier") == [("a",), ("c",)]
    touches = spark.createDataFrame(
        [("c", at(7), 1), ("c", at(9), 2), ("x", at(9), 3), ("x", at(9), 4)], "identifier STRING, ts TIMESTAMP_NTZ, seq BIGINT"
    )
    assert rows(state.touch(after, touches), "identifier", "modified") == [("a", at(5)), ("b", T), ("c", at(9))]
    assert rows(state.missed_touches(after, touches)) == [("x", 2)]


def test_append_keeps_both_of_an_instant(spark):
    one = spark.createDataFrame([("a", T, "<s> <p> <o> .")], schemas.IMMUTABLE)
    assert state.append_immutable(one, one).count() == 2


def test_root_is_made_once(spark, rows):
    none = spark.createDataFrame([], schemas.RESOURCES)
    once = state.ensure_root(none, F.lit(T).cast("timestamp_ntz"))
    twice = state.ensure_root(once, F.lit(at(9)).cast("timestamp_ntz"))
    assert rows(twice, "identifier", "interactionModel", "modified") == [("data:/", v.LDP_BASIC_CONTAINER, T)]


def version_rows(spark, *rows):
    full = [(i, v.LDP_RDF_SOURCE, None, None, None, t, t, n, q, t.replace(microsecond=0), None, None, None, None) for n, (i, t, q) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.VERSIONS)


def request_rows(spark, *rows):
    return spark.createDataFrame([(n, i, t) for n, (i, t) in enumerate(rows)], schemas.REQUESTS)


def test_version_at(spark, rows):
    held = version_rows(spark, ("a", T, None), ("a", at(10), None), ("a", at(200_000), None), ("b", at(0.5), None))
    asked = request_rows(
        spark,
        ("a", at(10) - timedelta(microseconds=250_000)),  # the exact second
        ("a", at(5)),  # latest before
        ("a", at(-99)),  # none before: the earliest
        ("a", at(150_000)),  # from an earlier day
        ("a", at(900_000)),
        ("b", at(-400_000)),  # the earliest is of a later day
        ("none", at(0)),
    )
    second = lambda s: at(s).replace(microsecond=0)
    want = [second(10), second(0), second(0), second(10), second(200_000), second(0), None]
    got = rows(versions.version_at(held, asked), "req", "version", "found")
    assert got == [(n, w, w is not None) for n, w in enumerate(want)]
    off = versions.version_at(held, asked, settings=Settings(versioning=False))
    assert {r[1:] for r in rows(off, "req", "version", "found")} == {(None, False)}


@pytest.mark.parametrize("bucket", [7, 60, asof.BUCKET_SECONDS])
def test_as_of_equals_brute_force_with_a_hot_id(spark, bucket):
    pick = random.Random(3)
    ids = ["hot"] * 5 + [f"r{i}" for i in range(10)]
    held = [(pick.choice(ids), pick.randrange(-300, 2_000)) for _ in range(900)]
    asked = [(pick.choice([*ids, "none"]), pick.randrange(-400, 2_400)) for _ in range(2_000)]

    def best(i, t):
        own = [x for j, x in held if j == i]
        before = [x for x in own if x <= t]
        return max(before) if before else min(own, default=None)

    got = asof.resolve(
        spark.createDataFrame(held, "identifier STRING, t BIGINT"),
        spark.createDataFrame(asked, "identifier STRING, t BIGINT"),
        bucket,
    ).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, t, best(i, t)) for i, t in set(asked)), key=repr)


def test_lists_and_choices(spark, rows):
    held = version_rows(spark, ("a", T, "1"), ("a", at(0.5), "2"), ("a", at(30), "3"), ("b", T, "4"))
    second = T.replace(microsecond=0)
    listed = [tuple(r) for r in versions.version_list(held).collect()]
    assert listed == [("a", second), ("a", at(30).replace(microsecond=0)), ("b", second)]
    assert rows(versions.version_dedup(held), "identifier", "quads") == [("a", "2"), ("a", "3"), ("b", "4")]
    assert rows(versions.version_dedup(held, "day"), "identifier", "quads") == [("a", "3"), ("b", "4")]
    assert rows(versions.first_version(held), "identifier", "quads") == [("a", "1"), ("b", "4")]
    assert rows(versions.first_version(held, "latest"), "identifier", "quads") == [("a", "3"), ("b", "4")]
    with pytest.raises(ValueError):
        versions.first_version(held, "newest")


def test_snapshots_are_versions(spark, rows):
    live = version_rows(spark, ("a", T, "x")).drop("mementomodified")
    made = state.snapshot(live, F.lit(at(3)).cast("timestamp_ntz"))
    assert rows(made, "modified", "mementomodified", "created") == [(T, T.replace(microsecond=0), at(3))]


def test_version_quads(spark, rows):
    held = version_rows(spark, ("a", T, '<a> <p> "1" .'), ("a", at(10), '<a> <p> "2" .\n<a> <p> "2" .'), ("b", T, None))
    asked = request_rows(spark, ("a", at(3)), ("a", at(30)), ("a", at(31)), ("b", T), ("none", T))
    got = rows(versions.version_quads(held, asked), "req", "object")
    typed = f"<{v.LDP_RDF_SOURCE}>"
    assert got == sorted(
        [(0, '"1"'), (0, typed), (1, '"2"'), (1, typed), (2, '"2"'), (2, typed), (3, typed)], key=repr
    )
    found = rows(versions.version_rows(held, asked, ["modified", "quads"]), "req", "version", "modified", "quads")
    second = T.replace(microsecond=0)
    assert found[0] == (0, second, T, '<a> <p> "1" .') and found[3:] == [(3, second, T, None), (4, None, None, None)]
    plain = versions.version_quads(held, asked, settings=Settings(add_type_quad=False))
    assert plain.count() == 3


def test_catalog(spark, rows):
    keys = ["m/k?version=1600000000", "m/k?version=1600000060", "m/k?version=1600000060", "m/k?version", "m/k?version=x"]
    objects = spark.createDataFrame([(k,) for k in keys], "key STRING")
    settings = Settings(version_key_prefix="m/")
    got = rows(versions.catalog(objects, settings))
    assert got == [("data:/k", datetime(2020, 9, 13, 12, 26, 40)), ("data:/k", datetime(2020, 9, 13, 12, 27, 40))]
    assert rows(versions.catalog_rejects(objects)) == [("m/k?version=x",)]


def test_meta_round_trip(spark, rows):
    full = [
        ("data:/a", v.LDP_INDIRECT_CONTAINER, "data:/", None, "text/plain", T, T, 1, "<s> <p> <o> <g1> .\n<s> <p> <o> <g0> .", T, "m", "r", "o", "i"),
        ("data:/b", v.LDP_NON_RDF_SOURCE, None, "s3://store/x", "text/plain", T, T, 1, None, T, None, None, None, None),
    ]
    made = versions.encode_meta(spark.createDataFrame(full, schemas.VERSIONS))
    meta = {r.key: r.meta for r in made.collect()}
    assert meta["b?version=1704110400"] == {
        "interactionModel": v.LDP_NON_RDF_SOURCE,
        "modified": "2024-01-01T12:00:00.250Z",
        "binaryLocation": "s3://store/x",
        "binaryMimeType": "text/plain",
        "metadataGraphs": "",
    }
    back = {r.identifier: r for r in versions.decode_meta(made).collect()}
    a, b = back["data:/a"], back["data:/b"]
    assert (a.membershipResource, a.memberRelation, a.memberOfRelation, a.insertedContentRelation) == ("m", "r", "o", "i")
    assert a.metadataGraphs == ["g0", "g1"] and a.modified == T and a.mimeType is None and a.container == "data:/"
    assert b.metadataGraphs == [] and b.binaryIdentifier == "s3://store/x" and b.container is None
    given = versions.encode_meta(spark.createDataFrame(full, schemas.VERSIONS), graphs=F.array(F.lit("x")))
    assert {r.meta["metadataGraphs"] for r in given.collect()} == {"x"}


def test_meta_defaults(spark):
    objects = spark.createDataFrame(
        [("k?version=1", {}, None), ("l?version=1", {"hasACL": "true", "metadataGraphs": "g"}, None)], schemas.OBJECTS
    )
    k, ell = sorted(versions.decode_meta(objects).collect(), key=lambda r: r.identifier)
    assert k.interactionModel == v.LDP_RESOURCE and k.modified is None and k.metadataGraphs == []
    assert ell.metadataGraphs == ["urn:x-system:PreferAccessControl"]
