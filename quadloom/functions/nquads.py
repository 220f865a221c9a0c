"""N-Quads terms and lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadloom.vocab import XSD_STRING

# Terminals of the W3C N-Quads grammar. Loops are possessive, so
# that matching neither backtracks nor recurses on literals of any length.
_HEX4 = r"u[0-9A-Fa-f]{4}"
_HEX8 = r"U[0-9A-Fa-f]{8}"
_IRI_CHAR = r"[^\x00-\x20<>\"{}|^`\\]"
_IRI = rf"<{_IRI_CHAR}*+(?:\\(?:{_HEX4}|{_HEX8}){_IRI_CHAR}*+)*+>"
_NAME_BASE = (
    r"A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u02FF\u0370-\u037D\u037F-\u1FFF\u200C-\u200D"
    r"\u2070-\u218F\u2C00-\u2FEF\u3001-\uD7FF\uF900-\uFDCF\uFDF0-\uFFFD\x{10000}-\x{EFFFF}"
)
_NAME_START = rf"{_NAME_BASE}_:"
_NAME_CHAR = rf"{_NAME_START}0-9\u00B7\u0300-\u036F\u203F-\u2040-"
_BLANK = rf"_:[{_NAME_START}0-9](?:[.{_NAME_CHAR}]*[{_NAME_CHAR}])?"
_QUOTED = rf"\"[^\"\\\n\r]*+(?:\\(?:[tbnrf\"'\\]|{_HEX4}|{_HEX8})[^\"\\\n\r]*+)*+\""
_LANG = r"@[A-Za-z]+(?:-[A-Za-z0-9]+)*"
_STRING_TYPE = rf"\^\^<{XSD_STRING}>"
_OBJECT = rf"({_IRI}|{_BLANK}|{_QUOTED}(?:{_LANG}|(?!{_STRING_TYPE})\^\^{_IRI})?)(?:(?<=\"){_STRING_TYPE})?"
_WS = r"[ \t]*"
LINE_PATTERN = (
    rf"{_WS}({_IRI}|{_BLANK}){_WS}({_IRI}){_WS}{_OBJECT}{_WS}({_IRI}|{_BLANK})?{_WS}\.{_WS}(?:#[^\n\r]*)?"
)

# A line never holds a line feed, so it can divide the four terms of a match.
_TERMS = "$1\n$2\n$3\n$4"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text: Column | str) -> Column:
    """The lines of a text, whichever line ends it has; some may be blank.

    Splitting at one character spares compiling a pattern for every text.
    """
    return F.split(F.replace(_col(text), F.lit("\r"), F.lit("\n")), "\n")


def is_statement(line: Column | str) -> Column:
    """False for blank and comment lines."""
    text = F.ltrim(_col(line), F.lit(" \t"))
    return (text != "") & ~text.startswith("#")


def line_terms(line: Column | str) -> Column:
    """``[subject, predicate, object, graph or '']``; one element for a bad line."""
    return F.split(F.regexp_replace(_col(line), rf"\A{LINE_PATTERN}\z", _TERMS), "\n")


def has_code_escape(line: Column | str) -> Column:
    line = _col(line)
    return line.contains("\\u") | line.contains("\\U")


def escape_text(text: Column | str) -> Column:
    """Escape what may not stand raw between the quotes of a literal."""
    out = _col(text)
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def _put_characters(marker: str, charset: str) -> Callable[[Column, Column], Column]:
    """A step that replaces one run of escapes by its characters, escaped where they must be."""

    def put(text: Column, code: Column) -> Column:
        chars = escape_text(F.decode(F.unhex(F.replace(code, F.lit(marker), F.lit(""))), charset))
        return F.replace(text, code, F.replace(chars, F.lit("\\\\"), F.lit("\n")))

    return put


def resolve_code_escapes(term: Column) -> Column:
    """Write ``\\uXXXX`` and ``\\UXXXXXXXX`` as the characters they stand for.

    Equal terms then have equal text. Escaped backslashes are set aside as line
    feeds while this runs, which a term cannot hold itself.
    """
    out = F.replace(term, F.lit("\\\\"), F.lit("\n"))
    for pattern, marker, charset in (
        (r"((?:\\u[0-9A-Fa-f]{4})+)", "\\u", "UTF-16BE"),
        (r"(\\U[0-9A-Fa-f]{8})", "\\U", "UTF-32"),
    ):
        found = F.array_distinct(F.regexp_extract_all(out, F.lit(pattern), F.lit(1)))
        # Longest first: a run of escapes may hold a shorter run that is also in the list.
        found = F.array_sort(found, lambda a, b: F.length(b) - F.length(a))

        out = F.aggregate(found, out, _put_characters(marker, charset))
    return F.replace(out, F.lit("\n"), F.lit("\\\\"))


def iri_term(iri: Column | str) -> Column:
    return F.concat(F.lit("<"), _col(iri), F.lit(">"))


def literal_term(text: Column | str, lang: Column | str | None = None, datatype: str | None = None) -> Column:
    parts = [F.lit('"'), escape_text(text), F.lit('"')]
    if lang is not None:
        parts += [F.lit("@"), _col(lang)]
    elif datatype is not None and datatype != XSD_STRING:
        parts.append(F.lit(f"^^<{datatype}>"))
    return F.concat(*parts)


def quad_line(subject="subject", predicate="predicate", obj="object", graph="graph") -> Column:
    """One N-Quads line without its line end; a null graph is the default graph."""
    return F.concat_ws(" ", *(_col(c) for c in (subject, predicate, obj, graph)), F.lit("."))


def graph_names(text: Column | str, ignored: tuple[str, ...] = ()) -> Column:
    """Sorted distinct graph IRIs named in one N-Quads text, without ``ignored``.

    Escapes are resolved as they are in quads, so that both name a graph alike.
    """
    terms = F.regexp_extract_all(_col(text), F.lit(rf"(?<![^\n\r]){LINE_PATTERN}(?![^\n\r])"), F.lit(4))
    iris = F.filter(terms, lambda t: t.startswith("<"))
    iris = F.transform(iris, lambda t: F.when(has_code_escape(t), resolve_code_escapes(t)).otherwise(t))
    names = F.transform(iris, lambda t: t.substr(F.lit(2), F.length(t) - 2))
    names = F.array_sort(F.array_distinct(names))
    return F.array_except(names, F.array(*map(F.lit, ignored))) if ignored else names
