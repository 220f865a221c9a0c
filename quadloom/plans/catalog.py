"""The registered queries: every operator over whole fixture tables.

Each takes (spark, sf_dir) and returns a DataFrame. Bytes are shown as hex and
arrays as joined text, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom import schemas
from quadloom.functions import keys, times
from quadloom.functions import nquads as nq
from quadloom.operators import binaries, quads, resources, state, versions
from quadloom.plans import fixtures as fx
from quadloom.session import work_folder
from quadloom.sources import objects, tables
from quadloom.sources.oplog import OpLog
from quadloom.sources.store import BucketStore
from quadloom.sources.views import ContainmentView
from quadloom.streaming import notifications as notes
from quadloom.streaming import ops as stream_ops_job
from quadloom.streaming.sources import stream_table
from quadloom.vocab import DEFAULTS, Settings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYED = Settings(version_key_prefix=fx.VERSION_PREFIX)
UNVERSIONED = Settings(versioning=False)
BUCKETS = 8


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _hex(name: str):
    return F.hex(name).alias(name)


def _joined(name: str):
    return F.array_join(F.array_sort(name), "|").alias(name)


# Quads -----------------------------------------------------------------------


@query
def nquads_ingest(spark, sf_dir):
    return quads.ingest(fx.nquads(spark, sf_dir))


@query
def nquads_quarantine(spark, sf_dir):
    return quads.quarantine(fx.nquads(spark, sf_dir))


@query
def nquads_split(spark, sf_dir):
    """Quads and bad lines of one parse."""
    good, bad, _ = quads.split(fx.nquads(spark, sf_dir))
    none = [F.lit(None).cast("string").alias(c) for c in ("graph", "subject", "predicate", "object")]
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(bad.select("identifier", "line", *none))


@query
def nquads_emit(spark, sf_dir):
    return quads.emit(fx.quads(spark, sf_dir), fx.ids(spark, sf_dir))


@query
def nquads_files(spark, sf_dir):
    """All quads written as N-Quads files, and read from there."""
    path = work_folder(spark, "nquads")
    lines = fx.quads(spark, sf_dir).select("identifier", nq.quad_line().alias("line"))
    objects.write_nquads(lines, path)
    return objects.read_nquads(spark, path).select("graph", "subject", "predicate", "object")


@query
def graph_filter(spark, sf_dir):
    return quads.only_graphs(fx.quads(spark, sf_dir), [DEFAULTS.user_graph, DEFAULTS.acl_graph])


@query
def graph_exclude(spark, sf_dir):
    return quads.without_graphs(fx.quads(spark, sf_dir), DEFAULTS.table_ignored_graphs)


def _contained_and_own(spark, sf_dir):
    index = resources.children(fx.resources(spark, sf_dir))
    return fx.quads(spark, sf_dir).unionByName(resources.containment_quads(index))


@query
def metadata_graphs(spark, sf_dir):
    return quads.metadata_graphs(_contained_and_own(spark, sf_dir), DEFAULTS.table_ignored_graphs)


@query
def metadata_graphs_object(spark, sf_dir):
    return quads.metadata_graphs(_contained_and_own(spark, sf_dir), DEFAULTS.object_ignored_graphs)


@query
def typed_quads(spark, sf_dir):
    return quads.type_quads(fx.resources(spark, sf_dir))


# Resources -------------------------------------------------------------------


@query
def assemble_resource(spark, sf_dir):
    return resources.assemble(fx.resources(spark, sf_dir), fx.immutable(spark, sf_dir))


@query
def assemble_ids(spark, sf_dir):
    """The same for the identifiers asked for, some of which are absent."""
    return resources.assemble(fx.resources(spark, sf_dir), fx.immutable(spark, sf_dir), fx.ids(spark, sf_dir))


@query
def assemble_stored(spark, sf_dir):
    """The same from tables saved in buckets by identifier."""
    frames = (fx.resources(spark, sf_dir), fx.immutable(spark, sf_dir))
    buckets = tables.buckets_for(*frames, least=BUCKETS)
    saved = [tables.save_bucketed(df, work_folder(spark, "stored"), buckets) for df in frames]
    return resources.assemble(*saved, fx.ids(spark, sf_dir))


@query
def assemble_ids_index(spark, sf_dir):
    """Containers and absent resources, with a saved containment index."""
    path = work_folder(spark, "index")
    resources.containment_index(fx.resources(spark, sf_dir)).write.parquet(path)
    asked = fx.table(spark, sf_dir, "customer").select(F.concat(F.lit("data:/customer/"), F.col("c_custkey").cast("string")).alias("identifier"))
    asked = asked.unionByName(fx.ids(spark, sf_dir).filter("identifier LIKE 'data:/absent/%'"))
    return resources.assemble(fx.resources(spark, sf_dir), fx.immutable(spark, sf_dir), asked, spark.read.parquet(path))


@query
def immutable_quads(spark, sf_dir):
    return resources.immutable_quads(fx.immutable(spark, sf_dir), fx.ids(spark, sf_dir))


@query
def resource_lookup(spark, sf_dir):
    found = resources.lookup(fx.ids(spark, sf_dir), fx.resources(spark, sf_dir))
    return found.select("identifier", "found", "interactionModel", "container", "modified", "quads")


@query
def metadata_projection(spark, sf_dir):
    return resources.metadata(fx.resources(spark, sf_dir)).select(
        "identifier",
        "interactionModel",
        "container",
        "modified",
        F.col("binary.identifier").alias("binaryIdentifier"),
        F.col("binary.mimeType").alias("mimeType"),
        _joined("metadataGraphs"),
    )


@query
def model_check(spark, sf_dir):
    checked = resources.check_models(fx.resources(spark, sf_dir))
    return checked.select("identifier", "interactionModel", "accepted")


@query
def containment(spark, sf_dir):
    return resources.containment_quads(resources.children(fx.resources(spark, sf_dir)))


@query
def containment_index(spark, sf_dir):
    return resources.containment_index(fx.resources(spark, sf_dir))


@query
def ready_probe(spark, sf_dir):
    return resources.is_ready(fx.resources(spark, sf_dir))


# State -----------------------------------------------------------------------


@query
def upsert_state(spark, sf_dir):
    """The state that ops of even numbers leave, with those of odd numbers written over it."""
    rows = fx.ops(spark, sf_dir).select("identifier", "value", F.col("ts").alias("created"), "seq")
    before = state.newest(rows.filter("seq % 2 = 0"), ["identifier"], state.ORDER)
    return state.upsert(before, rows.filter("seq % 2 = 1"))


@query
def delete_state(spark, sf_dir):
    toxic = fx.table(spark, sf_dir, "labels").filter("toxic = 1")
    gone = toxic.select(F.concat(F.lit("data:/doc/"), F.col("doc_id").cast("string")).alias("identifier"))
    left = state.delete(fx.resources(spark, sf_dir), gone)
    return left.select("identifier", "interactionModel", "container", "modified")


def _touches(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    kinds = F.array(
        F.concat(F.lit("data:/order/"), F.col("l_orderkey").cast("string")),
        F.concat(F.lit("data:/part/"), F.col("l_partkey").cast("string")),
    )
    return lines.select(
        F.explode(kinds).alias("identifier"), F.col("l_shipdate").alias("ts"), F.col("l_linenumber").alias("seq")
    )


@query
def touch_state(spark, sf_dir):
    touched = state.touch(fx.resources(spark, sf_dir), _touches(spark, sf_dir))
    return touched.select("identifier", "interactionModel", "modified")


@query
def touch_missed(spark, sf_dir):
    return state.missed_touches(fx.resources(spark, sf_dir), _touches(spark, sf_dir))


def _with_text(ops):
    """Ops with the N-Quads text that an ``add`` appends."""
    viewed = F.concat(
        nq.iri_term("identifier"),
        F.lit(f' <{fx.EX}viewed> "'),
        F.col("seq").cast("string"),
        F.lit(f'" <{DEFAULTS.audit_graph}> .'),
    )
    return ops.withColumn("text", viewed)


@query
def append_immutable(spark, sf_dir):
    log = _with_text(fx.ops(spark, sf_dir))
    return state.append_immutable(fx.immutable(spark, sf_dir), state.additions_of_ops(log, "text"))


@query
def fold_ops(spark, sf_dir):
    return state.fold_ops(fx.ops(spark, sf_dir), ["value"])


@query
def ensure_root(spark, sf_dir):
    rootless = fx.resources(spark, sf_dir).filter("container is not null")
    once = state.ensure_root(rootless, F.expr(fx.START))
    twice = state.ensure_root(once, F.expr(fx.START))
    return twice.select("identifier", "interactionModel", "container", "modified")


# Versions --------------------------------------------------------------------


@query
def snapshot_versions(spark, sf_dir):
    made = state.snapshot(fold_ops(spark, sf_dir))
    return made.select("identifier", "value", "modified", "mementomodified", "created", "seq")


@query
def version_list(spark, sf_dir):
    return versions.version_list(fx.versions(spark, sf_dir))


@query
def version_at(spark, sf_dir):
    got = versions.version_at(fx.versions(spark, sf_dir), fx.requests(spark, sf_dir))
    return got.select("req", "identifier", "version", "found")


@query
def version_at_stored(spark, sf_dir):
    """The same on versions saved in buckets by resource and span of time."""
    timed = versions.with_span(fx.versions(spark, sf_dir)).select("identifier", "span", "t", "quads")
    buckets = tables.buckets_for(timed, least=BUCKETS)
    saved = tables.save_bucketed(timed, work_folder(spark, "stored"), buckets, by=("identifier", "span"), order=["t"])
    got = versions.version_at_stored(saved, fx.requests(spark, sf_dir))
    return got.select("req", "identifier", "version", "found")


def _decoded(objects_df):
    return versions.decode_meta(objects_df, KEYED).filter(F.col("version").isNotNull())


@query
def version_at_objects(spark, sf_dir):
    """The same from the keys of version objects."""
    held = _decoded(fx.version_objects(spark, sf_dir))
    got = versions.version_at(held, fx.requests(spark, sf_dir), time="version")
    return got.select("req", "identifier", "version", "found")


@query
def version_quads_objects(spark, sf_dir):
    """Quads of chosen versions, which are written as objects and read from there."""
    path = work_folder(spark, "versions")
    versions.encode_meta(fx.versions(spark, sf_dir, spread=True), KEYED).write.parquet(path)
    held = _decoded(spark.read.parquet(path))
    return versions.version_quads(held, fx.requests(spark, sf_dir), time="version", order=["modified"])


_DEDUPED = ("identifier", "version", "modified", "seq", "container", "quads")


@query
def version_dedup(spark, sf_dir):
    return versions.version_dedup(fx.versions(spark, sf_dir)).select(*_DEDUPED)


@query
def version_dedup_day(spark, sf_dir):
    return versions.version_dedup(fx.versions(spark, sf_dir), "day").select(*_DEDUPED)


_ONE = ("identifier", "modified", "created", "seq", "interactionModel", "quads")


@query
def first_version(spark, sf_dir):
    return versions.first_version(fx.versions(spark, sf_dir), "earliest").select(*_ONE)


@query
def latest_version(spark, sf_dir):
    return versions.first_version(fx.versions(spark, sf_dir), "latest").select(*_ONE)


@query
def version_quads(spark, sf_dir):
    return versions.version_quads(fx.versions(spark, sf_dir), fx.requests(spark, sf_dir))


@query
def version_rows(spark, sf_dir):
    """All a request learns of its version but for the quads as rows."""
    columns = ["interactionModel", "container", "binaryIdentifier", "modified", "quads", "membershipResource"]
    return versions.version_rows(fx.versions(spark, sf_dir), fx.requests(spark, sf_dir), columns)


@query
def version_keys(spark, sf_dir):
    return versions.version_keys(fx.versions(spark, sf_dir), KEYED)


@query
def version_catalog(spark, sf_dir):
    return versions.catalog(fx.version_objects(spark, sf_dir), KEYED)


@query
def version_catalog_ids(spark, sf_dir):
    """Versions of one user per nation, and of others who never were, from objects stored by stem."""
    path = work_folder(spark, "stems")
    tables.write_table(versions.by_stem(fx.version_objects(spark, sf_dir)), path, BUCKETS, key="stem", order=["key"])
    number = F.explode(F.array(F.col("n_nationkey"), F.col("n_nationkey") + 1_000_000_000))
    asked = fx.table(spark, sf_dir, "nation").select(number.alias("k"))
    asked = asked.select(F.concat(F.lit("data:/user/"), F.col("k").cast("string")).alias("identifier"))
    return versions.catalog_of(tables.read_table(spark, path), asked, BUCKETS, KEYED)


@query
def version_catalog_rejects(spark, sf_dir):
    return versions.catalog_rejects(fx.version_objects(spark, sf_dir))


def _meta_text():
    pairs = F.transform(F.map_entries("meta"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), "|").alias("meta")


@query
def version_meta_encode(spark, sf_dir):
    made = versions.encode_meta(fx.versions(spark, sf_dir, spread=True), KEYED)
    return made.select("key", _meta_text(), "body")


@query
def version_meta_decode(spark, sf_dir):
    read = versions.decode_meta(fx.version_objects(spark, sf_dir), KEYED)
    return read.withColumn("metadataGraphs", _joined("metadataGraphs")).drop("quads")


@query
def version_meta_roundtrip(spark, sf_dir):
    """Versions written as objects and read back."""
    made = versions.encode_meta(fx.versions(spark, sf_dir, spread=True), KEYED)
    read = versions.decode_meta(made, KEYED)
    return read.withColumn("metadataGraphs", _joined("metadataGraphs"))


@query
def membership_projection(spark, sf_dir):
    return versions.membership(fx.versions(spark, sf_dir))


@query
def versioning_off(spark, sf_dir):
    got = versions.version_at(fx.versions(spark, sf_dir), fx.requests(spark, sf_dir), settings=UNVERSIONED)
    return got.select("req", "identifier", "version", "found")


# Binaries --------------------------------------------------------------------


@query
def chunk_binary(spark, sf_dir):
    return fx.chunks(spark, sf_dir).withColumn("chunk", _hex("chunk"))


@query
def chunk_binary_small(spark, sf_dir):
    return fx.chunks(spark, sf_dir, fx.SMALL_CHUNK).withColumn("chunk", _hex("chunk"))


@query
def chunk_size_hint(spark, sf_dir):
    sized = binaries.chunk_sizes(fx.hinted_binaries(spark, sf_dir), default=fx.CHUNK)
    return sized.select("identifier", "chunkSize", "error")


@query
def chunk_size_lookup(spark, sf_dir):
    return binaries.lookup_chunk_sizes(fx.binary_ids(spark, sf_dir), fx.chunks(spark, sf_dir))


@query
def set_content(spark, sf_dir):
    """Binaries written over others of the same identifiers; those with a bad hint leave what is there."""
    sized = binaries.chunk_sizes(fx.hinted_binaries(spark, sf_dir), default=2 * fx.CHUNK)
    written = binaries.set_content(fx.chunks(spark, sf_dir), sized)
    return written.withColumn("chunk", _hex("chunk"))


@query
def set_content_rejects(spark, sf_dir):
    sized = binaries.chunk_sizes(fx.hinted_binaries(spark, sf_dir), default=2 * fx.CHUNK)
    return binaries.unset_content(sized)


@query
def read_all(spark, sf_dir):
    read = binaries.read_all(fx.chunks(spark, sf_dir), fx.binary_ids(spark, sf_dir))
    return read.withColumn("content", _hex("content"))


@query
def read_all_segments(spark, sf_dir):
    """The same in segments of four chunks."""
    read = binaries.read_all(fx.chunks(spark, sf_dir), segment_bytes=4 * fx.CHUNK)
    return read.withColumn("content", _hex("content"))


@query
def binary_digest(spark, sf_dir):
    return binaries.digest(fx.chunks(spark, sf_dir))


@query
def object_digest(spark, sf_dir):
    return binaries.object_digest(fx.binary_contents(spark, sf_dir))


@query
def read_range(spark, sf_dir):
    read = binaries.read_range(fx.chunks(spark, sf_dir), fx.ranges(spark, sf_dir))
    return read.withColumn("content", _hex("content"))


@query
def read_range_small(spark, sf_dir):
    """The same on small chunks, answered in segments of 512 bytes."""
    small = fx.chunks(spark, sf_dir, fx.SMALL_CHUNK)
    read = binaries.read_range(small, fx.ranges(spark, sf_dir), segment_bytes=512)
    return read.withColumn("content", _hex("content"))


@query
def read_range_object(spark, sf_dir):
    whole = fx.binary_contents(spark, sf_dir)
    read = binaries.read_range_object(whole, fx.ranges(spark, sf_dir))
    return read.withColumn("content", _hex("content"))


@query
def purge_binary(spark, sf_dir):
    """Chunks left when the binaries of toxic documents are purged."""
    toxic = fx.table(spark, sf_dir, "labels").filter("toxic = 1")
    gone = toxic.select(F.concat(F.lit("s3://binaries/doc/"), F.col("doc_id").cast("string")).alias("identifier"))
    left = binaries.purge(fx.chunks(spark, sf_dir), gone)
    return left.select("identifier", "chunkIndex", F.octet_length("chunk").alias("bytes"))


@query
def chunk_audit(spark, sf_dir):
    return binaries.audit(fx.damaged_chunks(spark, sf_dir))


@query
def missing_chunks(spark, sf_dir):
    return binaries.missing_chunks(fx.damaged_chunks(spark, sf_dir))


@query
def chunk_audit_stored(spark, sf_dir):
    """The audit from lengths stored with the chunks: no content is read."""
    path = work_folder(spark, "chunks")
    binaries.with_digests(fx.damaged_chunks(spark, sf_dir)).write.parquet(path)
    return binaries.audit(spark.read.parquet(path))


@query
def binary_digest_stored(spark, sf_dir):
    """Digests of binaries from digests stored with their chunks."""
    path = work_folder(spark, "chunks")
    binaries.with_digests(fx.chunks(spark, sf_dir)).write.parquet(path)
    return binaries.digest(spark.read.parquet(path))


@query
def object_put(spark, sf_dir):
    """Documents put as objects, some of them twice, and read from the table of objects."""
    path = work_folder(spark, "objects")
    first = fx.binary_contents(spark, sf_dir)
    again = first.filter("source IN ('src1', 'src2')").withColumn("content", F.concat("content", F.lit(b"2")))
    for at, put in enumerate((again, first.filter("source <> 'src1'"), again.filter("source = 'src1'"))):
        made = binaries.put_objects(put, Settings(binary_key_prefix="store/"))
        objects.write_objects(made.withColumn("put", F.lit(at).cast("bigint")), path)
    return objects.read_objects(spark, path).select("key", _hex("content"), "mimeType")


# Keys and values -------------------------------------------------------------


@query
def binary_keys(spark, sf_dir):
    key = keys.binary_key("iri", Settings(binary_key_prefix="store/"))
    return fx.iris(spark, sf_dir).select("page_id", key.alias("key"), (key.isNull() & F.col("iri").isNotNull()).alias("rejected"))


@query
def iri_audit(spark, sf_dir):
    return fx.iris(spark, sf_dir).select("page_id", keys.iri_or_null("iri").alias("iri"), keys.iri_status("iri").alias("status"))


@query
def text_bytes(spark, sf_dir):
    """Whole texts as bytes, and those bytes as text again."""
    content = keys.text_to_bytes("text")
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.hex(content).alias("content"), keys.bytes_to_text(content).alias("text")
    )


@query
def instants(spark, sf_dir):
    """Event times cut to seconds, as epoch seconds and back, as text and back."""
    seconds = times.epoch_seconds("ts")
    text = times.format_instant("ts")
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        times.truncate_seconds("ts").alias("truncated"),
        seconds.alias("epoch"),
        times.from_epoch_seconds(seconds).alias("from_epoch"),
        text.alias("text"),
        times.parse_instant(text).alias("parsed"),
    )


MINTED = r"\As3://[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\z"


def _minted(spark, sf_dir):
    return fx.resources(spark, sf_dir).select("identifier", keys.mint_identifier("s3://").alias("minted"))


@query
def minted_ids(spark, sf_dir):
    """Each resource, and whether the id minted for it looks as it should."""
    return _minted(spark, sf_dir).select("identifier", F.col("minted").rlike(MINTED).alias("well_formed"))


@query
def minted_ids_check(spark, sf_dir):
    """How many ids were minted, how many differ, and how many look as they should."""
    return _minted(spark, sf_dir).groupBy("minted").agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("minted"),
        F.count("*").alias("distinct_ids"),
        F.count_if(F.col("minted").rlike(MINTED)).alias("well_formed"),
    )


# Storage and streams ---------------------------------------------------------


@query
def table_lookup(spark, sf_dir):
    """Resources written as a bucketed table, and found there by identifier."""
    path = work_folder(spark, "resources")
    tables.write_table(fx.resources(spark, sf_dir), path, BUCKETS, order=["created"])
    table = tables.read_table(spark, path)
    found = tables.rows_of_keys(table, fx.ids(spark, sf_dir), BUCKETS)
    return found.select("identifier", "interactionModel", "container", "modified")


def _changed_store(spark, sf_dir) -> tuple[BucketStore, list[Callable[[], int]]]:
    """Resources at rest, and two batches of writes and one of deletions to apply to them."""
    moved, changed, gone = fx.resource_changes(spark, sf_dir)
    store = BucketStore(spark, work_folder(spark, "store"), schemas.RESOURCES, BUCKETS)
    store.replace(fx.resources(spark, sf_dir))
    return store, [lambda: store.upsert(moved), lambda: store.upsert(changed), lambda: store.delete(gone)]


@query
def store_state(spark, sf_dir):
    """Resources at rest after batches of writes and deletions."""
    store, batches = _changed_store(spark, sf_dir)
    for batch in batches:
        batch()
    return store.read().select("identifier", "interactionModel", "container", "modified")


@query
def store_snapshot(spark, sf_dir):
    """What a reader has that opened the store before the deletions."""
    store, batches = _changed_store(spark, sf_dir)
    batches[0]()
    batches[1]()
    opened = store.read()
    batches[2]()
    return opened.select("identifier", "interactionModel", "container", "modified")


@query
def store_purge(spark, sf_dir):
    """Chunks at rest after the binaries of toxic documents are purged."""
    toxic = fx.table(spark, sf_dir, "labels").filter("toxic = 1")
    gone = toxic.select(F.concat(F.lit("s3://binaries/doc/"), F.col("doc_id").cast("string")).alias("identifier"))
    store = BucketStore(spark, work_folder(spark, "store"), schemas.CHUNKS, BUCKETS, order=["chunkIndex"])
    store.replace(fx.chunks(spark, sf_dir))
    store.delete(gone)
    return store.read().select("identifier", "chunkIndex", F.octet_length("chunk").alias("bytes"))


@query
def containment_view(spark, sf_dir):
    """Children by container, kept beside the store; one batch is followed late."""
    store, batches = _changed_store(spark, sf_dir)
    view = ContainmentView(store, work_folder(spark, "view"))
    view.refresh()
    batches[0]()
    view.refresh()
    batches[1]()
    batches[2]()
    view.refresh()
    return view.read()


@query
def chunk_files(spark, sf_dir):
    """Documents written as text files by source and lot, in order of their ids; every chunk of every file."""
    path = work_folder(spark, "files")
    lots = fx.table(spark, sf_dir, "documents").withColumn("lot", F.col("doc_id") % 8).repartition("source", "lot")
    lots.sortWithinPartitions("source", "lot", "doc_id").select("source", "lot", "text").write.partitionBy("source", "lot").text(path)
    made = objects.chunk_files(spark, path, 64 * fx.CHUNK)
    return made.filter(F.col("identifier").endswith(".txt")).select(
        F.regexp_extract("identifier", "source=([^/]*)/", 1).alias("source"),
        F.regexp_extract("identifier", "lot=([^/]*)/", 1).cast("bigint").alias("lot"),
        "size", "chunkSize", "chunkIndex", F.md5("chunk").alias("md5"),
    )


BATCHES = 5


def _event_stream(spark, sf_dir):
    """Events as a stream of several batches, in no order of time."""
    path = work_folder(spark, "events")
    fx.table(spark, sf_dir, "events").repartition(BATCHES, F.col("event_id") % 101).write.parquet(path)
    return stream_table(spark, path, files_per_trigger=1)


@query
def stream_notifications(spark, sf_dir):
    """A stream of several batches to a topic that refuses some messages."""
    folder = work_folder(spark, "notifications")

    def publish(messages):
        refused = F.when(F.col("id").endswith("7"), F.lit("refused by the topic"))
        return messages.withColumn("reason", F.coalesce("reason", refused))

    job = notes.emit(fx.notifications_of(_event_stream(spark, sf_dir)), f"{folder}/out", f"{folder}/checkpoint", publish)
    job.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("id", "message", "reason")


def _streamed_log(spark, sf_dir) -> OpLog:
    folder = work_folder(spark, "ops")
    log = OpLog(spark, f"{folder}/ops", ["value", "text"])
    ops = _with_text(fx.ops_of(_event_stream(spark, sf_dir)))
    stream_ops_job.append_ops(ops, log, f"{folder}/checkpoint", compact_every=2).awaitTermination()
    return log


@query
def stream_ops(spark, sf_dir):
    """Current state after a stream of ops, read from the compacted log."""
    return _streamed_log(spark, sf_dir).current().drop("text")


@query
def stream_versions(spark, sf_dir):
    """The versions and append-only rows which the same stream left."""
    log = _streamed_log(spark, sf_dir)
    made = log.versions().select("identifier", F.col("modified").alias("at"), F.lit("version").alias("kind"))
    added = log.additions("text").select("identifier", F.col("created").alias("at"), F.lit("addition").alias("kind"))
    return made.unionByName(added)


@query
def stream_dedup(spark, sf_dir):
    """Notifications of several batches, in which each copy is some batches from the first."""
    folder = work_folder(spark, "dedup")
    path = work_folder(spark, "events")
    sent = fx.notifications_of(fx.table(spark, sf_dir, "events"))
    sent.repartition(BATCHES).write.parquet(path)
    stream = stream_table(spark, path, files_per_trigger=1)
    notes.dedup(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    read = spark.read.parquet(f"{folder}/out")
    return read.select("id", "object", _joined("agents"), _joined("types"), _joined("objectTypes"), "created")
