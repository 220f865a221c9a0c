"""Reading the current state of resources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.functions import keys
from quadloom.functions import nquads as nq
from quadloom.operators import quads as q
from quadloom.operators.keyed import distinct_keys, picked, rows_with_keys
from quadloom.schemas import QUAD_COLUMNS
from quadloom.vocab import DEFAULTS, LDP_CONTAINS, PREFER_CONTAINMENT, STORABLE_MODELS, Settings


def lookup(ids: DataFrame, resources: DataFrame) -> DataFrame:
    """The row of each identifier asked for, with ``found``.

    ``ids`` may repeat identifiers; each is answered. The optimizer broadcasts
    a side only after it has measured it as small, and splits a hot identifier
    on the asking side, as resources hold one row per identifier.
    """
    return ids.join(resources.withColumn("found", F.lit(True)), "identifier", "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def metadata(resources: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """identifier, interactionModel, container, modified, binary, metadataGraphs.

    ``binary`` is null without a binary identifier, whatever the mime type.
    """
    location = keys.iri_or_null("binaryIdentifier")
    binary = F.struct(location.alias("identifier"), F.col("mimeType"))
    graphs = nq.graph_names("quads", settings.table_ignored_graphs)
    return resources.select(
        "identifier",
        keys.iri_or_null("interactionModel").alias("interactionModel"),
        keys.iri_or_null("container").alias("container"),
        "modified",
        F.when(location.isNotNull(), binary).alias("binary"),
        F.coalesce(graphs, F.array().cast("array<string>")).alias("metadataGraphs"),
    )


def immutable_quads(immutable: DataFrame, ids: DataFrame, distinct: bool = True) -> DataFrame:
    """Append-only quads of the identifiers asked for, over all their rows."""
    asked = rows_with_keys(immutable, ids)
    return q.ingest(asked, distinct=distinct)


def children(resources: DataFrame) -> DataFrame:
    """(container, identifier, interactionModel) of all contained resources."""
    contained = resources.filter(F.col("identifier").isNotNull() & F.col("container").isNotNull())
    return contained.select("container", "identifier", "interactionModel")


def containment_index(resources: DataFrame, partitions: int | None = None) -> DataFrame:
    """``children`` clustered by container, ready to be written as a table.

    Ranges of (container, identifier) keep a container's rows together and
    still divide one that holds a large share of everything.
    """
    by = ["container", "identifier"]
    index = children(resources)
    ranged = index.repartitionByRange(partitions, *by) if partitions else index.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


def containment_quads(index: DataFrame) -> DataFrame:
    """One containment quad per contained resource. No shuffle."""
    return index.select(
        F.col("container").alias("identifier"),
        F.lit(f"<{PREFER_CONTAINMENT}>").alias("graph"),
        nq.iri_term(keys.with_slash("container")).alias("subject"),
        F.lit(f"<{LDP_CONTAINS}>").alias("predicate"),
        nq.iri_term(keys.with_slash("identifier", "interactionModel")).alias("object"),
    )


def assemble(
    resources: DataFrame,
    immutable: DataFrame,
    ids: DataFrame | None = None,
    index: DataFrame | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """All quads of resources: mutable, append-only, containment and type quads.

    Identifiers without a row in ``resources`` yield nothing. ``ids`` limits
    the answer. What is wanted is told from the rest by narrow rows
    (identifier, whether it is a container), which are written once and
    measured: texts do not move until they are quads (``Picked.met``).
    ``index`` is a saved containment index, if there is one.
    """
    index = children(resources) if index is None else index
    standing = resources.select("identifier", keys.is_container("interactionModel").alias("container_"))
    standing = standing if ids is None else rows_with_keys(standing, ids)
    standing = picked(standing.distinct(), "standing")
    found = resources if ids is None else standing.met(resources)
    containers = picked(standing.rows.filter("container_").select("identifier"), "containers")
    contained = containers.met(containment_quads(index))
    audited = standing.met(immutable)
    # The type quad goes through the parser with the text, which saves a scan.
    texts = found.select("identifier", F.concat_ws("\n", "quads", q.type_line(settings)).alias("quads"))
    whole = q.ingest(texts, distinct=False)
    for part in (q.ingest(audited, distinct=False), contained):
        whole = whole.unionByName(part.select(*QUAD_COLUMNS))
    return distinct_keys(whole, *QUAD_COLUMNS)


def check_models(resources: DataFrame) -> DataFrame:
    """Add ``accepted``: whether the interaction model may be stored."""
    known = F.col("interactionModel").isin(*STORABLE_MODELS)
    return resources.withColumn("accepted", F.coalesce(known, F.lit(False)))


def is_ready(table: DataFrame) -> DataFrame:
    """One row: whether the table has any row. Stops at the first one found."""
    return table.select(F.lit(1)).limit(1).agg((F.count("*") > 0).alias("ready"))
