from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quadloom.functions import keys, times
from quadloom.functions import nquads as nq
from quadloom.vocab import LDP_BASIC_CONTAINER, LDP_RDF_SOURCE, Settings


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "text, second, epoch, iso",
    [
        ("2024-03-10 02:30:01.5", datetime(2024, 3, 10, 2, 30, 1), 1710037801, "2024-03-10T02:30:01.500Z"),
        ("2024-01-01 00:00:07.179575", datetime(2024, 1, 1, 0, 0, 7), 1704067207, "2024-01-01T00:00:07.179575Z"),
        ("1969-12-31 23:59:58.5", datetime(1969, 12, 31, 23, 59, 58), -2, "1969-12-31T23:59:58.500Z"),
        ("2024-01-01 00:00:00", datetime(2024, 1, 1), 1704067200, "2024-01-01T00:00:00Z"),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone, text, second, epoch, iso):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ts = ntz(text)
        assert one(spark, times.truncate_seconds(ts)) == second
        assert one(spark, times.epoch_seconds(ts)) == epoch
        assert one(spark, times.from_epoch_seconds(times.epoch_seconds(ts))) == second
        assert one(spark, times.format_instant(ts)) == iso
        assert one(spark, times.parse_instant(times.format_instant(ts)) == ts)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_granularity_and_words(spark):
    ts = ntz("2024-03-10 02:30:01.5")
    assert one(spark, times.truncate_to(ts, "day")) == datetime(2024, 3, 10)
    assert one(spark, times.truncate_to(ts, "hour")) == datetime(2024, 3, 10, 2)
    assert one(spark, times.parse_instant(F.lit("yesterday"))) is None


def test_slash(spark):
    basic, source = F.lit(LDP_BASIC_CONTAINER), F.lit(LDP_RDF_SOURCE)
    assert one(spark, keys.with_slash(F.lit("a"), basic)) == "a/"
    assert one(spark, keys.with_slash(F.lit("a/"), basic)) == "a/"
    assert one(spark, keys.with_slash(F.lit("a"), source)) == "a"
    assert one(spark, keys.with_slash(F.lit("a"))) == "a/"


def test_binary_key(spark):
    settings = Settings(binary_key_prefix="p/")
    assert one(spark, keys.binary_key(F.lit("s3://x/y"), settings)) == "p/x/y"
    assert one(spark, keys.binary_key(F.lit("file:///x"), settings)) is None


@pytest.mark.parametrize(
    "key, version",
    [
        ("a/b?version=1600000000", datetime(2020, 9, 13, 12, 26, 40)),
        ("a/b?version=-1", datetime(1969, 12, 31, 23, 59, 59)),
        ("a/b?version", None),
        ("a/b?version=", None),
        ("a/b?version=1.5", None),
        ("a/b?version=+0000000000001600000000", datetime(2020, 9, 13, 12, 26, 40)),
        ("a/b?version=160000000000000", None),
        ("a/b?version=x?version=1600000000", None),
        ("a/b?version=1600000000?version=1600000000", None),
        ("a/b?version= 1600000000", None),
        ("a/\nb?version=1600000000", datetime(2020, 9, 13, 12, 26, 40)),
        ("a/b?version=12/other", None),
        ("a/b?version=100000000000", datetime(5138, 11, 16, 9, 46, 40)),
        ("a/b?version=99999999999999", None),
        ("a/b?version=99999999999999999999", None),
        ("a/b", None),
    ],
)
def test_version_keys(spark, key, version):
    assert one(spark, keys.version_of_key(F.lit(key))) == version


def test_version_key_round_trip(spark):
    settings = Settings(version_key_prefix="m/")
    key = keys.version_key(F.lit("data:/a/b"), ntz("2020-09-13 12:26:40.9"), settings)
    assert one(spark, key) == "m/a/b?version=1600000000"
    assert one(spark, keys.identifier_of_version_key(key, settings)) == "data:/a/b"
    assert one(spark, keys.identifier_of_version_key(F.lit("a?version=1"), settings)) == "data:/a"


@pytest.mark.parametrize(
    "iri, status",
    [
        ("http://example.com/a#b", "valid"),
        ("two words", "invalid"),
        ("no-scheme", "invalid"),
        ("http://example.com/<a>", "invalid"),
        ("http://example.com/\n", "invalid"),
        ("", "null"),
        (None, "null"),
    ],
)
def test_iri_status(spark, iri, status):
    assert one(spark, keys.iri_status(F.lit(iri).cast("string"))) == status


def test_text_and_bytes(spark):
    assert bytes(one(spark, keys.text_to_bytes(F.lit("é")))) == b"\xc3\xa9"
    assert one(spark, keys.bytes_to_text(keys.text_to_bytes(F.lit("é")))) == "é"
    assert one(spark, keys.text_to_bytes(F.lit(None).cast("string"))) is None


S, P, O, G = "<http://s>", "<http://p>", "<http://o>", "<http://g>"


@pytest.mark.parametrize(
    "line, terms",
    [
        (f"{S} {P} {O} {G} .", [S, P, O, G]),
        (f"{S} {P} {O} .", [S, P, O, ""]),
        (f"\t{S}{P}{O}{G}.  # comment", [S, P, O, G]),
        (f"_:a.b {P} _:c _:g1 .", ["_:a.b", P, "_:c", "_:g1"]),
        (f"_:a {P} _:c.", ["_:a", P, "_:c", ""]),
        (f'{S} {P} "x" .', [S, P, '"x"', ""]),
        (f'{S} {P} "x"@en-GB {G} .', [S, P, '"x"@en-GB', G]),
        (f'{S} {P} "1"^^<http://t> .', [S, P, '"1"^^<http://t>', ""]),
        (f'{S} {P} "x"^^<http://www.w3.org/2001/XMLSchema#string> {G} .', [S, P, '"x"', G]),
        (f'{S} {P} "a \\"b\\" \\\\ \\n <http://not> ." {G} .', [S, P, '"a \\"b\\" \\\\ \\n <http://not> ."', G]),
        (f'{S} {P} "" .', [S, P, '""', ""]),
        (f"<http://é/\\u00e9> {P} {O} .", ["<http://é/\\u00e9>", P, O, ""]),
        (f"{S} {P} {O} {G}", None),
        (f'"x" {P} {O} .', None),
        (f"{S} _:p {O} .", None),
        (f'{S} {P} "x .', None),
        (f'{S} {P} "x\\q" .', None),
        (f"{S} {P} {O} {G} {G} .", None),
        (f"{S} {P} <http://a b> .", None),
        (f'{S} {P} {O} "g" .', None),
        (f"{S} {P} {O} . extra", None),
        ("nonsense", None),
    ],
)
def test_line_terms(spark, line, terms):
    assert one(spark, nq.line_terms(F.lit(line))) == (terms or [line])


@pytest.mark.parametrize("filler", ["x", "\\n", "\\\\", "\\u00e9"])
def test_long_literals_neither_fail_nor_backtrack(spark, filler):
    literal = f'"{filler * 200_000}"'
    assert one(spark, nq.line_terms(F.lit(f"{S} {P} {literal} .")))[2] == literal
    open_line = f'{S} {P} "{filler * 200_000} .'
    assert one(spark, nq.line_terms(F.lit(open_line))) == [open_line]


@pytest.mark.parametrize(
    "term, resolved",
    [
        ('"\\u00e9"', '"é"'),
        ('"\\U0001F600 \\uD83D\\uDE00"', '"😀 😀"'),
        ('"\\\\u00e9"', '"\\\\u00e9"'),
        ('"\\\\\\u00e9"', '"\\\\é"'),
        ('"\\u0022\\u005C\\u000A"', '"\\"\\\\\\n"'),
        ('"\\u0041 \\u0041\\u0042"', '"A AB"'),
        ("<http://\\u00e9>", "<http://é>"),
        ('"plain \\n"', '"plain \\n"'),
    ],
)
def test_code_escapes(spark, term, resolved):
    assert one(spark, nq.resolve_code_escapes(F.lit(term))) == resolved


def test_graph_names(spark):
    text = f"{S} {P} {O} {G} .\n{S} {P} {O} .\n{S} {P} {O} _:b .\r\n{S} {P} {O} <http://a> .\n# {S} {P} {O} <http://c> ."
    assert one(spark, nq.graph_names(F.lit(text))) == ["http://a", "http://g"]
    assert one(spark, nq.graph_names(F.lit(text), ("http://g",))) == ["http://a"]
    # Escapes are resolved before names are compared, as in quads.
    text = f"{S} {P} {O} <http://\\u0067> .\n{S} {P} {O} <http://x/\\U0000e9> .\n{S} {P} {O} <http://\\u0061> ."
    assert one(spark, nq.graph_names(F.lit(text), ("http://g",))) == ["http://a"]


def test_literals_round_trip(spark):
    text = 'a "b" \\ \n \r c'
    line = nq.quad_line(F.lit(S), F.lit(P), nq.literal_term(F.lit(text)), F.lit(None).cast("string"))
    assert one(spark, nq.line_terms(line))[2] == '"a \\"b\\" \\\\ \\n \\r c"'
