"""Versions of resources: listing, time travel, object keys and metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadloom import vocab as v
from quadloom.functions import keys, times
from quadloom.functions import nquads as nq
from quadloom.operators import asof
from quadloom.operators import quads as q
from quadloom.operators.keyed import distinct_keys
from quadloom.operators.state import ORDER, newest
from quadloom.schemas import MEMBERSHIP_COLUMNS, QUAD_COLUMNS
from quadloom.session import written
from quadloom.sources.tables import rows_of_keys
from quadloom.vocab import DEFAULTS, Settings


def version_list(versions: DataFrame, time: str = "modified", settings: Settings = DEFAULTS) -> DataFrame:
    """Distinct version times per identifier, in whole seconds, ascending.

    ``time`` is the column a version's time is in: ``version``, from the key,
    for decoded objects.
    """
    held = versions.filter(F.lit(settings.versioning))
    held = held.select("identifier", times.truncate_seconds(time).alias("version"))
    return distinct_keys(held, "identifier", "version").orderBy("identifier", "version")


def version_at(
    versions: DataFrame,
    requests: DataFrame,
    time: str = "modified",
    bucket_seconds: int = asof.BUCKET_SECONDS,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """The version time each request (req, identifier, at) gets, and ``found``.

    The exact second if there is one, else the latest before, else the earliest.
    """
    asked, resolved = _resolve(versions, requests, time, bucket_seconds, settings)
    # Requests join back by (identifier, t): one row on the right for each, so
    # a hot pair is on the left only, where the optimizer may divide it.
    return asked.join(resolved, ["identifier", "t"], "left").select(
        *requests.columns,
        times.from_epoch_seconds("version_t").alias("version"),
        F.col("version_t").isNotNull().alias("found"),
    )


def version_at_stored(
    stored: DataFrame, requests: DataFrame, bucket_seconds: int = asof.BUCKET_SECONDS, settings: Settings = DEFAULTS
) -> DataFrame:
    """``version_at`` on versions saved with ``with_span`` in buckets by (identifier, span).

    Only versions of spans in which something is asked, and two of each other
    span of the same resources, leave the place where they are stored.
    """
    held = stored.filter(F.lit(settings.versioning))
    asked = requests.withColumn("t", times.epoch_seconds("at"))
    near = asof.reduced(held, asked, bucket_seconds).withColumn("time", times.from_epoch_seconds("t"))
    return version_at(near, requests, "time", bucket_seconds, settings)


def with_span(versions: DataFrame, time: str = "modified", bucket_seconds: int = asof.BUCKET_SECONDS) -> DataFrame:
    """``versions`` with their second ``t`` and the ``span`` it lies in, ready to be saved in buckets by (identifier, span)."""
    timed = versions.withColumn("t", times.epoch_seconds(time))
    return timed.withColumn("span", asof.span_of("t", bucket_seconds))


def _resolve(versions, requests, time, bucket_seconds, settings) -> tuple[DataFrame, DataFrame]:
    """Requests with their second ``t``, and the version of each (identifier, t)."""
    held = versions.filter(F.lit(settings.versioning))
    held = held.select("identifier", times.epoch_seconds(time).alias("t"))
    asked = requests.withColumn("t", times.epoch_seconds("at"))
    return asked, asof.resolve(held, asked, bucket_seconds)


def first_version(versions: DataFrame, which: str = "earliest") -> DataFrame:
    """One version row per identifier: ``earliest`` or ``latest`` created."""
    if which not in ("earliest", "latest"):
        raise ValueError(f"which must be 'earliest' or 'latest', not {which!r}")
    return newest(versions, ["identifier"], ORDER, oldest=which == "earliest")


def version_dedup(versions: DataFrame, granularity: str = "second") -> DataFrame:
    """Versions where a later write in one unit of time replaces the earlier."""
    keyed = versions.withColumn("version", times.truncate_to("modified", granularity))
    return newest(keyed, ["identifier", "version"], ORDER)


def version_rows(
    versions: DataFrame,
    requests: DataFrame,
    columns: Sequence[str],
    time: str = "modified",
    order: Sequence[str] = ORDER,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """The version each request gets: req, identifier, version and its ``columns``.

    Of versions with the same second the last in ``order`` counts. A request
    for a resource without versions gets nulls.

    Requests are matched on narrow rows, which are written once, and so is the
    choice among versions of one second. Rows of the versions chosen are then
    fetched, and go out to their requests by a key of their own, so that a
    version many requests get can be divided among tasks.
    """
    asked, resolved = _resolve(versions, requests, time, asof.BUCKET_SECONDS, settings)
    resolved = written(resolved, "resolved")
    got = asked.select("req", "identifier", "t").join(resolved, ["identifier", "t"], "left")
    by = ["identifier", "version_t"]
    wanted = resolved.filter(F.col("version_t").isNotNull()).select(*by).distinct()
    named = [F.col(c).alias(f"_{n}") for n, c in enumerate(columns)]
    ranked = [F.col(c).alias(f"_order{n}") for n, c in enumerate(order)]
    keyed = versions.select("identifier", times.epoch_seconds(time).alias("version_t"), *named, *ranked)
    held = newest(keyed, by, [f"_order{n}" for n, _ in enumerate(order)], among=wanted)
    key = F.struct(*by).alias("k")
    rows = got.select("req", key).join(held.select(key, *[f"_{n}" for n, _ in enumerate(columns)]), "k", "left")
    return rows.select(
        "req",
        "k.identifier",
        times.from_epoch_seconds("k.version_t").alias("version"),
        *[F.col(f"_{n}").alias(c) for n, c in enumerate(columns)],
    )


def version_quads(
    versions: DataFrame,
    requests: DataFrame,
    time: str = "modified",
    order: Sequence[str] = ORDER,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Quads of the version each request gets: req and the quad columns."""
    rows = version_rows(versions, requests, ["interactionModel", "quads"], time, order, settings)
    text = F.concat_ws("\n", "quads", q.type_line(settings)).alias("quads")
    texts = rows.select(F.struct("req", "identifier").alias("identifier"), text)
    quads = q.ingest(texts, distinct=True)
    return quads.select("identifier.*", *QUAD_COLUMNS[1:])


def version_keys(versions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """identifier, modified, and the object key of the version."""
    return versions.select(
        "identifier", "modified", keys.version_key("identifier", "modified", settings).alias("key")
    )


def catalog(objects: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Distinct (identifier, version) of the version objects in a listing.

    Keys without a version, with one that is not a whole number, or with a
    slash in it, which belong to other resources, are left out.
    """
    listed = objects.select(
        keys.identifier_of_version_key("key", settings).alias("identifier"),
        keys.version_of_key("key").alias("version"),
    )
    return distinct_keys(listed.filter(F.col("version").isNotNull()), "identifier", "version")


def by_stem(objects: DataFrame) -> DataFrame:
    """``objects`` with the ``stem`` that the keys of all versions of a resource share, to be stored by that.

    ``tables.write_table(by_stem(objects), path, buckets, key="stem", order=["key"])``
    lays the versions of a resource together, sorted.
    """
    return objects.withColumn("stem", keys.stem_of_version_key("key"))


def catalog_of(stored: DataFrame, ids: DataFrame, buckets: int, settings: Settings = DEFAULTS) -> DataFrame:
    """``catalog`` for the identifiers asked for, from objects stored by their stem.

    Only folders of the stems asked for are opened, and only keys with one of
    these are parsed.
    """
    stems = ids.select(keys.version_key_stem("identifier", settings).alias("stem")).filter("stem IS NOT NULL")
    return catalog(rows_of_keys(stored, stems, buckets, key="stem"), settings)


def catalog_rejects(objects: DataFrame) -> DataFrame:
    """Keys that carry a version mark but no usable version."""
    marked = keys.version_text_of_key("key").isNotNull()
    return objects.filter(marked & keys.version_of_key("key").isNull()).select("key")


def encode_meta(
    versions: DataFrame, settings: Settings = DEFAULTS, graphs: Column | None = None
) -> DataFrame:
    """Version rows as objects (key, meta, body). Absent attributes get no key.

    ``graphs`` is an array of metadata graph IRIs; by default those named in
    the version's own quads.
    """
    names = nq.graph_names("quads", settings.object_ignored_graphs) if graphs is None else graphs
    names = F.coalesce(names, F.array().cast("array<string>"))
    model, mime, location = F.col("interactionModel"), F.col("mimeType"), F.col("binaryIdentifier")
    values = {
        v.META_MODEL: model,
        v.META_MODIFIED: times.format_instant("modified"),
        v.META_CONTAINER: F.col("container"),
        v.META_BINARY_LOCATION: location,
        v.META_BINARY_TYPE: F.when(location.isNotNull(), mime),
        v.META_MEMBERSHIP_RESOURCE: F.col("membershipResource"),
        v.META_MEMBER_RELATION: F.col("memberRelation"),
        v.META_MEMBER_OF_RELATION: F.col("memberOfRelation"),
        v.META_INSERTED_CONTENT: F.col("insertedContentRelation"),
        v.META_GRAPHS: F.array_join(names, ","),
    }
    pairs = [x for name, value in values.items() for x in (F.lit(settings.meta_prefix + name), value)]
    meta = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
    return versions.select(
        keys.version_key("identifier", "modified", settings).alias("key"),
        meta.alias("meta"),
        F.col("quads").alias("body"),
    )


def decode_meta(objects: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Objects (key, meta, body) as version rows with ``metadataGraphs``."""

    def get(name: str) -> Column:
        return F.col("meta").getItem(settings.meta_prefix + name)

    listed = get(v.META_GRAPHS)
    graphs = (
        F.when(get(v.META_HAS_ACL).isNotNull(), F.array(F.lit(settings.acl_graph)))
        .when(listed != "", F.split(listed, ","))
        .otherwise(F.array().cast("array<string>"))
    )
    location = get(v.META_BINARY_LOCATION)
    return objects.select(
        keys.identifier_of_version_key("key", settings).alias("identifier"),
        keys.version_of_key("key").alias("version"),
        F.coalesce(get(v.META_MODEL), F.lit(v.LDP_RESOURCE)).alias("interactionModel"),
        times.parse_instant(get(v.META_MODIFIED)).alias("modified"),
        get(v.META_CONTAINER).alias("container"),
        location.alias("binaryIdentifier"),
        F.when(location.isNotNull(), get(v.META_BINARY_TYPE)).alias("mimeType"),
        get(v.META_MEMBERSHIP_RESOURCE).alias("membershipResource"),
        get(v.META_MEMBER_RELATION).alias("memberRelation"),
        get(v.META_MEMBER_OF_RELATION).alias("memberOfRelation"),
        get(v.META_INSERTED_CONTENT).alias("insertedContentRelation"),
        F.array_distinct(graphs).alias("metadataGraphs"),
        F.col("body").alias("quads"),
    )


def membership(versions: DataFrame) -> DataFrame:
    """The four membership IRIs of every version, null where it has none."""
    return versions.select("identifier", "modified", *MEMBERSHIP_COLUMNS)
