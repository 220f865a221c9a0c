import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quadloom.operators import binaries
from quadloom.vocab import Settings

SOURCE = "identifier STRING, content BINARY, chunkSize INT"
SIZES = [0, 1, 3, 4, 7, 8, 9, 40, 41]


def contents():
    pick = random.Random(1)
    return {f"b{n}": pick.randbytes(n) for n in SIZES}


def chunked(spark, size=4, held=None):
    held = contents() if held is None else held
    return binaries.chunk(spark.createDataFrame([(i, c, size) for i, c in held.items()], SOURCE))


@pytest.mark.parametrize("n, want", [(0, [0]), (3, [3]), (4, [4, 0]), (7, [4, 3]), (8, [4, 4, 0])])
def test_the_last_chunk_is_never_full(spark, n, want):
    got = chunked(spark, held={"x": bytes(n)}).orderBy("chunkIndex").collect()
    assert [len(r.chunk) for r in got] == want
    assert {(r.size, r.chunkSize) for r in got} == {(n, 4)}


@pytest.mark.parametrize("segment", [4, 8, 12, 1_000])
def test_chunk_then_read_is_identity(spark, segment):
    ids = spark.createDataFrame([(i,) for i in [*contents(), "none"]], "identifier STRING")
    got = {}
    for r in binaries.read_all(chunked(spark), ids, segment).orderBy("segment").collect():
        assert r.found == (r.identifier != "none")
        got[r.identifier] = got.get(r.identifier, b"") + bytes(r.content or b"")
        assert len(r.content or b"") <= segment
    assert got == {**contents(), "none": b""}


def test_hints(spark):
    hints = [None, ["7"], ["7", "8"], ["0"], ["-1"], ["x"], [], [None], ["99999999999"]]
    df = spark.createDataFrame([(str(n), h) for n, h in enumerate(hints)], "identifier STRING, hints ARRAY<STRING>")
    got = [(r.chunkSize, r.error) for r in binaries.chunk_sizes(df).orderBy("identifier").collect()]
    below, word = "chunk size below 1", "not a number"
    assert got == [
        (1_048_576, None),
        (7, None),
        (None, "too many chunk sizes"),
        (None, below),
        (None, below),
        (None, word),
        (None, "no chunk size"),
        (None, word),
        (None, word),
    ]


def test_chunk_size_lookup(spark, rows):
    chunks = chunked(spark, held={"a": b"12345"})
    bad = chunks.withColumn("identifier", F.lit("bad")).withColumn("chunkSize", F.lit(0))
    ids = spark.createDataFrame([("a",), ("bad",), ("none",)], "identifier STRING")
    assert rows(binaries.lookup_chunk_sizes(ids, chunks.unionByName(bad))) == [
        ("a", 4, None),
        ("bad", 0, "chunk size below 1 for bad"),
        ("none", None, "missing binary none"),
    ]


def ranges(spark, *asked):
    return spark.createDataFrame([(n, *r) for n, r in enumerate(asked)], "req BIGINT, identifier STRING, `from` BIGINT, `to` BIGINT")


def test_known_ranges(spark):
    chunks = chunked(spark, held={"a": b"0123456789", "j": b"abcdefgh"})
    asked = ranges(
        spark, ("a", 3, 6), ("j", 5, 10**12), ("a", 10, 20), ("none", 0, 5), ("a", 9, 9), ("a", 900, 10**15), ("j", 0, 7)
    )
    got = [(bytes(r.content) if r.content is not None else None, r.found) for r in binaries.read_range(chunks, asked).orderBy("req").collect()]
    assert got == [
        (b"3456", True),
        (b"fgh", True),
        (b"", True),
        (None, False),
        (b"9", True),
        (b"", True),
        (b"abcdefgh", True),
    ]


@pytest.mark.parametrize("segment", [8, 1_000])
def test_ranges_equal_brute_force_with_a_hot_binary(spark, segment):
    held, pick = contents(), random.Random(2)
    names = ["b41"] * 9 + list(held)
    asked = []
    for _ in range(400):
        start = pick.randrange(50)
        asked.append((pick.choice(names), start, start + pick.randrange(30)))
    got = {}
    for r in binaries.read_range(chunked(spark), ranges(spark, *asked), segment).orderBy("req", "segment").collect():
        got[r.req] = got.get(r.req, b"") + bytes(r.content)
        assert len(r.content) <= segment
    assert got == {n: held[i][a : b + 1] for n, (i, a, b) in enumerate(asked)}


def test_long_ranges_are_listed_in_steps(spark, monkeypatch):
    monkeypatch.setattr(binaries, "_RUN", 3)
    held = {"b": random.Random(4).randbytes(101)}
    got = binaries.read_range(chunked(spark, held=held), ranges(spark, ("b", 1, 99))).collect()
    assert bytes(got[0].content) == held["b"][1:100]


def test_object_ranges(spark):
    objects = spark.createDataFrame([("f", b"0123456789")], "identifier STRING, content BINARY")
    asked = ranges(spark, ("f", 5, 8), ("f", 100, 110), ("none", 0, 1), ("f", 7, 10**12))
    got = [r.content if r.content is None else bytes(r.content) for r in binaries.read_range_object(objects, asked).orderBy("req").collect()]
    assert got == [b"5678", b"", None, b"789"]


def test_replacing_drops_the_old_tail(spark, rows):
    before = chunked(spark, held={"a": bytes(40), "b": b"bb"})
    new = spark.createDataFrame([("a", b"short", 4)], SOURCE)
    after = binaries.set_content(before, new)
    assert rows(after, "identifier", "chunkIndex", "chunk") == [("a", 0, b"shor"), ("a", 1, b"t"), ("b", 0, b"bb")]
    # A hint or content that can't be used leaves what is there, and is told.
    bad = spark.createDataFrame([("a", b"new", 0), ("b", None, 4), ("b", b"x", None)], SOURCE)
    assert rows(binaries.set_content(before, bad)) == rows(before)
    assert rows(binaries.unset_content(bad)) == [("a", "no usable chunk size"), ("b", "no content"), ("b", "no usable chunk size")]
    twice = spark.createDataFrame([("a", b"1st", 4, 1), ("a", b"2nd", 4, 2)], SOURCE + ", at INT")
    newest = binaries.set_content(before.filter("identifier = 'a'"), twice, order=["at"])
    assert rows(newest, "chunkIndex", "chunk") == [(0, b"2nd")]
    gone = spark.createDataFrame([("a",)], "identifier STRING")
    assert rows(binaries.purge(after, gone), "identifier") == [("b",)]


def test_audit(spark, rows):
    whole = chunked(spark, held={n: bytes(10) for n in ("ok", "gap", "last", "short", "headless")})
    damaged = whole.filter(
        "NOT (identifier = 'gap' AND chunkIndex = 1) AND NOT (identifier = 'last' AND chunkIndex = 2)"
        " AND NOT (identifier = 'headless' AND chunkIndex = 0)"
    ).withColumn("chunk", F.expr("CASE WHEN identifier = 'short' AND chunkIndex = 1 THEN X'00' ELSE chunk END"))
    # A short write over a longer one that left its tail.
    tail = chunked(spark, held={"tail": bytes(30)}).filter("chunkIndex > 1").unionByName(chunked(spark, held={"tail": bytes(5)}))
    assert rows(binaries.audit(damaged.unionByName(tail))) == [
        ("gap", 2, 1, 0, 0),
        ("headless", 2, 1, 0, 0),
        ("last", 2, 1, 0, 0),
        ("ok", 3, 0, 0, 0),
        ("short", 3, 0, 1, 0),
        ("tail", 8, 0, 0, 6),
    ]
    assert rows(binaries.missing_chunks(damaged)) == [("gap", 1), ("headless", 0), ("last", 2)]
    # A chunk of an older write does not fill the gap of the current one.
    old = chunked(spark, held={"gap": bytes(11)}).filter("chunkIndex = 1")
    mixed = damaged.filter("identifier = 'gap'").unionByName(old)
    assert rows(binaries.missing_chunks(mixed)) == [("gap", 1)]
    assert rows(binaries.audit(mixed)) == [("gap", 3, 1, 0, 1)]


def test_digests(spark):
    got = {r.identifier: r for r in binaries.digest(chunked(spark)).collect()}
    for name, content in contents().items():
        assert got[name].bytes == len(content)
        node = [hashlib.md5(content[i : i + 4]).hexdigest() for i in range(0, len(content) // 4 * 4 + 1, 4)]
        for _ in range(3):
            node = [hashlib.md5("".join(node).encode()).hexdigest()]
        assert got[name].tree_md5 == node[0]
    whole = spark.createDataFrame(list(contents().items()), "identifier STRING, content BINARY")
    for r in binaries.object_digest(whole).collect():
        assert (r.bytes, r.md5) == (len(contents()[r.identifier]), hashlib.md5(contents()[r.identifier]).hexdigest())


def test_small_chunks_do_not_make_large_groups(spark, monkeypatch):
    monkeypatch.setattr(binaries, "_SEGMENT_CHUNKS", 2)
    content = bytes(range(20))
    got = binaries.read_all(chunked(spark, held={"a": content})).orderBy("segment").collect()
    assert [len(r.content) for r in got] == [8, 8, 4] and b"".join(bytes(r.content) for r in got) == content


def test_the_digest_tree_groups_by_position(spark, monkeypatch):
    monkeypatch.setattr(binaries, "_FANOUT", 2)
    content = bytes(range(20))
    got = binaries.digest(chunked(spark, held={"a": content})).first().tree_md5
    node = [hashlib.md5(content[i : i + 4]).hexdigest() for i in range(0, 21, 4)]
    for _ in range(3):
        node = [hashlib.md5("".join(node[i : i + 2]).encode()).hexdigest() for i in range(0, len(node), 2)]
    assert [got] == node


def test_objects(spark, rows):
    df = spark.createDataFrame([("s3://a/b", b"1", None), ("file:/c", b"2", "text/plain")], "identifier STRING, content BINARY, mimeType STRING")
    assert rows(binaries.put_objects(df, Settings(binary_key_prefix="p/"))) == [("p/a/b", b"1", None)]
