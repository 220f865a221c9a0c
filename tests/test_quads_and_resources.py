import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quadloom import schemas
from quadloom import vocab as v
from quadloom.operators import quads, resources
from quadloom.vocab import DEFAULTS, Settings

U, SERVER = f"<{DEFAULTS.user_graph}>", f"<{DEFAULTS.server_graph}>"
T = datetime(2024, 1, 1)


def texts(spark, *rows):
    return spark.createDataFrame(rows, "identifier STRING, quads STRING")


def quad_rows(spark, *rows):
    return spark.createDataFrame(rows, schemas.QUADS)


def test_ingest_is_a_set_and_keeps_bad_lines_apart(spark, rows):
    df = texts(
        spark,
        ("a", '<s> <p> "1" <g> .\n<s>  <p>  "1"^^<http://www.w3.org/2001/XMLSchema#string> <g>.\n\n# note\nbad\n'),
        ("b", None),
        ("c", ""),
        ("d", "<s> <p> <o> ."),
        ("d", "<s> <p> <o> ."),
    )
    assert rows(quads.ingest(df)) == [("a", "<g>", "<s>", "<p>", '"1"'), ("d", None, "<s>", "<p>", "<o>")]
    assert quads.ingest(df, distinct=False).count() == 4
    assert rows(quads.quarantine(df)) == [("a", "bad")]


def test_equal_terms_written_differently_are_one(spark):
    df = texts(spark, ("a", '<s> <p> "\\u00e9" .\n<s> <p> "é" .'))
    assert quads.ingest(df).count() == 1


def test_emit(spark, rows):
    df = quad_rows(
        spark,
        ("a", U, "<s>", "<p>", '"2"'),
        ("a", None, "<s>", "<p>", '"1"'),
        ("a", U, "<s>", "<p>", '"2"'),
        ("a", SERVER, "<s>", "<p>", '"3"'),
        ("b", SERVER, "<s>", "<p>", '"3"'),
    )
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "identifier STRING")
    text = f'<s> <p> "1" .\n<s> <p> "2" {U} .'
    assert rows(quads.emit(df)) == [("a", 0, text)]
    assert rows(quads.emit(df, ids)) == [("a", 0, text), ("b", 0, None), ("c", 0, None)]


def test_large_resources_are_emitted_in_parts_and_stay_whole(spark):
    many = spark.range(5_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), F.col("id"))).alias("identifier"),
        F.lit(U).alias("graph"),
        F.lit("<s>").alias("subject"),
        F.lit("<p>").alias("predicate"),
        F.concat(F.lit('"'), F.col("id"), F.lit('"')).alias("object"),
    )
    out = quads.emit(many, part_bytes=4_096)
    sizes = {r[0]: r[1] for r in out.groupBy("identifier").count().collect()}
    assert sizes["hot"] > 30 and set(n for i, n in sizes.items() if i != "hot") == {1}
    assert out.agg(F.max(F.length("quads"))).first()[0] < 3 * 4_096
    back = quads.ingest(out.select("identifier", "quads"))
    assert back.exceptAll(many).count() == 0 and many.exceptAll(back).count() == 0


def test_graphs(spark, rows):
    df = quad_rows(
        spark,
        ("a", U, "<s>", "<p>", "<o>"),
        ("a", "<x>", "<s>", "<p>", "<o>"),
        ("a", "<x>", "<s>", "<p>", "<o2>"),
        ("a", "_:b", "<s>", "<p>", "<o>"),
        ("a", None, "<s>", "<p>", "<o>"),
        ("b", f"<{v.PREFER_CONTAINMENT}>", "<s>", "<p>", "<o>"),
    )
    assert rows(quads.only_graphs(df, ["x"]), "object") == [("<o2>",), ("<o>",)]
    assert quads.without_graphs(df, ["x"]).count() == 4
    assert rows(quads.metadata_graphs(df)) == [("a", "x"), ("b", v.PREFER_CONTAINMENT)]
    assert rows(quads.metadata_graphs(df, DEFAULTS.object_ignored_graphs)) == [("a", "x")]


def res(spark, *rows):
    full = [(i, m, c, b, mime, T, T, n, q) for n, (i, m, c, b, mime, q) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.RESOURCES)


def sample(spark):
    return res(
        spark,
        ("data:/", v.LDP_BASIC_CONTAINER, None, None, None, None),
        ("data:/c", v.LDP_CONTAINER, "data:/", None, None, f'<data:/c> <p> "c" {U} .'),
        ("data:/c/d", v.LDP_DIRECT_CONTAINER, "data:/c", None, None, None),
        ("data:/c/x", v.LDP_RDF_SOURCE, "data:/c", None, "text/plain", "<data:/c/x> <p> <o> <g> ."),
        ("data:/c/b", v.LDP_NON_RDF_SOURCE, "data:/c/x", "s3://b", "text/plain", None),
    )


def test_lookup_answers_every_id(spark, rows):
    ids = spark.createDataFrame([("data:/c",), ("data:/none",), ("data:/c",)], "identifier STRING")
    got = rows(resources.lookup(ids, sample(spark)), "identifier", "found", "container")
    assert got == [("data:/c", True, "data:/"), ("data:/c", True, "data:/"), ("data:/none", False, None)]


def test_metadata(spark):
    got = {r.identifier: r for r in resources.metadata(sample(spark)).collect()}
    assert got["data:/c/x"].binary is None and got["data:/c/x"].metadataGraphs == ["g"]
    assert tuple(got["data:/c/b"].binary) == ("s3://b", "text/plain")
    assert got["data:/c"].metadataGraphs == [] and got["data:/"].metadataGraphs == []


def test_containment(spark, rows):
    graph, contains = f"<{v.PREFER_CONTAINMENT}>", f"<{v.LDP_CONTAINS}>"
    index = resources.containment_index(sample(spark), 2)
    assert rows(resources.containment_quads(index)) == [
        ("data:/", graph, "<data:/>", contains, "<data:/c/>"),
        ("data:/c", graph, "<data:/c/>", contains, "<data:/c/d/>"),
        ("data:/c", graph, "<data:/c/>", contains, "<data:/c/x>"),
        ("data:/c/x", graph, "<data:/c/x/>", contains, "<data:/c/b>"),
    ]


def test_assemble(spark, rows):
    immutable = spark.createDataFrame(
        [
            ("data:/c", T, "<data:/c> <p> <audit> <a> ."),
            ("data:/c", T, "<data:/c> <p> <audit> <a> ."),
            ("data:/gone", T, "<data:/gone> <p> <audit> <a> ."),
        ],
        schemas.IMMUTABLE,
    )
    whole = resources.assemble(sample(spark), immutable)
    # Own quads, audit quads, children of containers, types.
    assert whole.count() == 2 + 1 + 3 + 5
    ids = spark.createDataFrame([("data:/c",), ("data:/gone",)], "identifier STRING")
    got = rows(resources.assemble(sample(spark), immutable, ids), "graph", "object")
    assert set(got) == {
        (SERVER, f"<{v.LDP_CONTAINER}>"),
        ("<a>", "<audit>"),
        (f"<{v.PREFER_CONTAINMENT}>", "<data:/c/d/>"),
        (f"<{v.PREFER_CONTAINMENT}>", "<data:/c/x>"),
        (U, '"c"'),
    }
    assert len(got) == 5
    untyped = resources.assemble(sample(spark), immutable, ids, settings=Settings(add_type_quad=False))
    assert untyped.count() == 4
    index = resources.children(sample(spark)).filter("identifier <> 'data:/c/x'")
    assert resources.assemble(sample(spark), immutable, ids, index).count() == 4


def test_models_and_probe(spark, rows):
    checked = rows(resources.check_models(sample(spark)), "identifier", "accepted")
    assert [i for i, ok in checked if not ok] == ["data:/c/d"]
    assert resources.is_ready(sample(spark)).first()[0] is True
    assert resources.is_ready(sample(spark).filter("false")).first()[0] is False


def test_any_text_survives_as_a_literal(spark):
    """Random texts, hard characters among them, become lines, quads and texts again."""
    pick = random.Random(9)
    hard = ['"', "\\", "\n", "\r", "\t", " ", ".", "<", ">", "#", "@", "^", "é", "😀", " ", "\x85", "\x01", "u0041", "_:"]
    sent = [(f"r{n}", "".join(pick.choice([*hard, "a", "b"]) for _ in range(pick.randrange(30)))) for n in range(400)]
    df = spark.createDataFrame(sent, "identifier STRING, text STRING")
    line = quads.nq.quad_line(F.lit("<s>"), F.lit("<p>"), quads.nq.literal_term("text"), F.lit("<g>"))
    read = quads.ingest(df.select("identifier", line.alias("quads")))
    assert quads.quarantine(df.select("identifier", line.alias("quads"))).count() == 0
    marks = {"n": "\n", "r": "\r", '"': '"', "\\": "\\"}
    plain = {r.identifier: re.sub(r"\\(.)", lambda m: marks[m[1]], r.object[1:-1]) for r in read.collect()}
    assert plain == dict(sent)
    again = quads.ingest(quads.emit(read).select("identifier", "quads"))
    assert again.exceptAll(read).count() == 0 and again.count() == len(sent)


def test_one_parse_gives_quads_bad_lines_and_counts(spark, rows):
    df = spark.createDataFrame([("a", "<s> <p> <o> .\n# c\nbad\n<s> <p> <o> ."), ("b", None), ("c", "<s> <p> \"\\u0041\" <g> .\nworse")], "identifier STRING, quads STRING")
    good, bad, counts = quads.split(df)
    assert rows(good) == rows(quads.ingest(df)) and rows(bad) == rows(quads.quarantine(df))
    assert counts == {"good": 3, "bad": 2}
    with pytest.raises(ValueError, match="2 of 5"):
        quads.split(df, most_bad=0.3)
    quads.split(df, most_bad=0.4)
    assert quads.split(df.filter("identifier = 'b'"))[2] == {"good": 0, "bad": 0}
