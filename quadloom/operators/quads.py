"""Reading, writing and filtering quads.

A quads table has the columns identifier, graph, subject, predicate and object.
The last four hold N-Quads terms; a null graph is the default graph.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quadloom.functions import nquads as nq
from quadloom.operators.keyed import distinct_keys, rows_with_keys
from quadloom.schemas import QUAD_COLUMNS
from quadloom.session import written
from quadloom.vocab import DEFAULTS, RDF_TYPE, Settings

# Most bytes of N-Quads put into one text value.
TEXT_PART_BYTES = 64 * 1024 * 1024


def _line_terms(lines: DataFrame) -> DataFrame:
    """identifier, line -> those with a statement, plus its ``terms``."""
    return lines.filter(nq.is_statement("line")).withColumn("terms", nq.line_terms("line"))


def _lines_of_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(
        F.col(id_col).alias("identifier"), F.explode(nq.split_lines(text_col)).alias("line")
    )


def quads_of_lines(lines: DataFrame) -> DataFrame:
    """Quads of a table (identifier, line); lines that do not parse are left out.

    The terms leave through a generator and not through a filter, because a
    filter on them would be pushed down and match every line twice.
    """
    resolved = F.when(nq.has_code_escape("line"), F.transform("terms", nq.resolve_code_escapes))
    parsed = _line_terms(lines).withColumn("terms", resolved.otherwise(F.col("terms")))
    t = F.col("terms")
    quad = F.struct(
        F.nullif(t[3], F.lit("")).alias("graph"),
        t[0].alias("subject"),
        t[1].alias("predicate"),
        t[2].alias("object"),
    )
    good = F.when(F.size(t) == 4, F.array(quad))
    return parsed.select("identifier", F.inline(good)).select(*QUAD_COLUMNS)


def bad_lines(lines: DataFrame) -> DataFrame:
    """The lines of a table (identifier, line) that do not parse."""
    return _line_terms(lines).filter(F.size("terms") != 4).select("identifier", "line")


def ingest(df: DataFrame, id_col="identifier", text_col="quads", distinct: bool = True) -> DataFrame:
    """Quads of a column of N-Quads texts, each identifier's quads being a set.

    ``distinct=False`` needs no shuffle; use it when a union and its distinct follow.
    """
    quads = quads_of_lines(_lines_of_texts(df, id_col, text_col))
    return distinct_keys(quads, *QUAD_COLUMNS) if distinct else quads


def quarantine(df: DataFrame, id_col="identifier", text_col="quads") -> DataFrame:
    """The lines of a column of N-Quads texts that ``ingest`` leaves out."""
    return bad_lines(_lines_of_texts(df, id_col, text_col))


def split(
    df: DataFrame, id_col="identifier", text_col="quads", most_bad: float | None = None
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """``ingest`` and ``quarantine`` of one parse: quads, bad lines, and how many lines were good and bad.

    Texts are read and parsed once; both outputs are written, and the counts
    taken meanwhile. ``most_bad`` is a gate: where more than that share of the
    lines is bad, this fails.
    """
    parsed = _line_terms(_lines_of_texts(df, id_col, text_col))
    resolved = F.when(nq.has_code_escape("line"), F.transform("terms", nq.resolve_code_escapes))
    t = resolved.otherwise(F.col("terms"))
    good = F.size("terms") == 4
    rows = parsed.select("identifier", F.when(~good, F.col("line")).alias("line"), F.when(good, t).alias("terms"), good.alias("good"))
    seen = Observation()
    counted = rows.observe(seen, F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    both = written(counted, "parsed", "good")
    counts = dict(seen.get)
    lines = counts["good"] + counts["bad"]
    if most_bad is not None and counts["bad"] > most_bad * lines:
        raise ValueError(f"{counts['bad']} of {lines} lines are no quads")
    terms = F.col("terms")
    found = both.filter("good").select(
        "identifier", F.nullif(terms[3], F.lit("")).alias("graph"), terms[0].alias("subject"), terms[1].alias("predicate"), terms[2].alias("object")
    )
    return distinct_keys(found, *QUAD_COLUMNS), both.filter("not good").select("identifier", "line"), counts


def emit(
    quads: DataFrame,
    ids: DataFrame | None = None,
    part_bytes: int = TEXT_PART_BYTES,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """N-Quads text per identifier as (identifier, part, quads).

    Quads of the server-managed graph are dropped. With ``ids`` given, only
    those are written, once each, and one without quads gets a null text. A
    resource of more than ``part_bytes`` is spread by hash over several parts
    whose union it is, so no task or row holds more than about that; any other
    is in part 0 alone.
    """
    server = nq.iri_term(F.lit(settings.server_graph))
    kept = quads.filter(F.col("graph").isNull() | (F.col("graph") != server))
    asked = kept
    if ids is not None:
        ids = distinct_keys(ids)
        asked = rows_with_keys(kept, ids)
    lines = asked.select("identifier", nq.quad_line().alias("line"))
    # A narrow row per resource, written once: large ones lie in a folder of
    # their own, whose size tells the optimizer how to join them.
    sizes = lines.groupBy("identifier").agg(F.sum(F.octet_length("line") + 1).alias("bytes"))
    sizes = written(sizes.withColumn("large", F.col("bytes") > part_bytes), "sizes", "large")
    large = sizes.filter("large").select(
        F.col("identifier").alias("h"), F.ceil(F.col("bytes") / part_bytes).cast("int").alias("parts")
    )
    part = F.pmod(F.xxhash64("line"), F.coalesce("parts", F.lit(1))).cast("int")
    # Grouping by one struct: a partitioning the join may leave behind, by
    # identifier alone, would otherwise be reused and put all parts in one task.
    texts = (
        lines.join(large, F.col("identifier") == F.col("h"), "left")
        .groupBy(F.struct("identifier", part.alias("part")).alias("k"))
        .agg(F.array_join(F.array_sort(F.collect_set("line")), "\n").alias("quads"))
        .select("k.identifier", "k.part", "quads")
    )
    if ids is None:
        return texts
    # Texts are not joined to ids: all parts of a large one would meet in a task.
    empty = ids.join(sizes.select("identifier"), "identifier", "left_anti")
    nothing = empty.select("identifier", F.lit(0).alias("part"), F.lit(None).cast("string").alias("quads"))
    return texts.unionByName(nothing)


def only_graphs(quads: DataFrame, graphs: Sequence[str]) -> DataFrame:
    return quads.filter(F.col("graph").isin(*[f"<{g}>" for g in graphs]))


def without_graphs(quads: DataFrame, graphs: Sequence[str]) -> DataFrame:
    listed = F.col("graph").isin(*[f"<{g}>" for g in graphs])
    return quads.filter(F.col("graph").isNull() | ~listed)


def metadata_graphs(quads: DataFrame, ignored: Sequence[str] | None = None) -> DataFrame:
    """Distinct (identifier, graph) of graph IRIs which are not in ``ignored``.

    One row per graph, so a resource with many graphs is nobody's array.
    """
    ignored = DEFAULTS.table_ignored_graphs if ignored is None else ignored
    named = quads.filter(F.col("graph").startswith("<"))
    name = F.expr("substring(graph, 2, length(graph) - 2)")
    kept = named.select("identifier", name.alias("graph")).filter(~F.col("graph").isin(*ignored))
    return distinct_keys(kept, "identifier", "graph")


def type_line(settings: Settings = DEFAULTS, identifier="identifier", model="interactionModel") -> Column:
    """The server-managed type quad of a resource as an N-Quads line; null when switched off."""
    line = nq.quad_line(
        nq.iri_term(identifier),
        F.lit(f"<{RDF_TYPE}>"),
        nq.iri_term(model),
        F.lit(f"<{settings.server_graph}>"),
    )
    return F.when(F.lit(settings.add_type_quad) & F.col(model).isNotNull(), line)


def type_quads(resources: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One server-managed type quad per resource; no rows when switched off."""
    return resources.filter(F.lit(settings.add_type_quad)).select(
        "identifier",
        nq.iri_term(F.lit(settings.server_graph)).alias("graph"),
        nq.iri_term("identifier").alias("subject"),
        nq.iri_term(F.lit(RDF_TYPE)).alias("predicate"),
        nq.iri_term("interactionModel").alias("object"),
    )
