"""Linked-data tables derived from the given tables, whole and by expression.

Every row of the source tables is used. Conditions only vary what a row
holds, so that each case an operator knows occurs. FIXTURES.md says the same
in words; oracles.py holds the SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom import vocab as v
from quadloom.functions import nquads as nq
from quadloom.functions import times
from quadloom.operators import binaries
from quadloom.vocab import DEFAULTS

EX = "http://example.com/ns#"
ACL_READ = "http://www.w3.org/ns/auth/acl#Read"
ACL_MODE = "http://www.w3.org/ns/auth/acl#mode"
XSD_INTEGER = "http://www.w3.org/2001/XMLSchema#integer"
AUDIT_ESCAPED = DEFAULTS.audit_graph.replace("a", "\\u0061", 1)
# Seconds that put a version's number of them at twelve digits.
FAR = 100_000_000_000
START = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"
CHUNK = 1_024
SMALL_CHUNK = 16
TASKS_PER_CORE = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"data:/{kind}/"), F.col(key).cast("string"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _ex(name: str) -> Column:
    return F.lit(f"<{EX}{name}>")


def _order_quads(server: bool) -> list[tuple[Column, Column, Column, Column, Column]]:
    """The quads an order may have: condition, graph, subject, predicate, object."""
    always, default = F.lit(True), F.lit(None).cast("string")
    user, acl = F.lit(f"<{DEFAULTS.user_graph}>"), F.lit(f"<{DEFAULTS.acl_graph}>")
    subject = nq.iri_term(_id("order", "o_orderkey"))
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    priority = F.col("o_orderpriority")
    said = nq.literal_term(F.concat(F.lit('said "hi" to \\ customer '), customer), lang=F.lit("en"))
    blank, blank_graph = F.concat(F.lit("_:b"), key), F.concat(F.lit("_:g"), key)
    quads = [
        (always, user, subject, _ex("status"), nq.literal_term("o_orderstatus")),
        (always, user, subject, _ex("priority"), nq.literal_term("o_orderpriority")),
        (priority == "1-URGENT", acl, subject, F.lit(f"<{ACL_MODE}>"), F.lit(f"<{ACL_READ}>")),
        (priority == "2-HIGH", default, subject, _ex("customer"), nq.literal_term(customer, datatype=XSD_INTEGER)),
        (priority == "4-NOT SPECIFIED", blank_graph, blank, _ex("note"), said),
    ]
    if server:
        graph, model = F.lit(f"<{DEFAULTS.server_graph}>"), F.lit(f"<{v.LDP_RDF_SOURCE}>")
        quads.append((always, graph, subject, F.lit(f"<{v.RDF_TYPE}>"), model))
    return quads


def _order_text() -> Column:
    lines = [F.when(when, nq.quad_line(s, p, o, g)) for when, g, s, p, o in _order_quads(server=False)]
    return F.concat_ws("\n", *lines)


def _document_text() -> Column:
    return nq.quad_line(
        nq.iri_term(_id("doc", "doc_id")),
        F.lit("<http://purl.org/dc/terms/description>"),
        nq.literal_term("text", lang=F.col("lang")),
        F.lit(f"<{DEFAULTS.user_graph}>"),
    )


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A container tree: root, regions, nations, customers; orders and documents in it."""
    start = F.expr(START)

    def rows(df, identifier, model, container, key, modified=start, binary=None, mime=None, text=None):
        null = F.lit(None).cast("string")
        return df.select(
            identifier.alias("identifier"),
            model.alias("interactionModel"),
            container.alias("container"),
            (null if binary is None else binary).alias("binaryIdentifier"),
            (null if mime is None else mime).alias("mimeType"),
            modified.alias("modified"),
            modified.alias("created"),
            key.cast("bigint").alias("seq"),
            (null if text is None else text).alias("quads"),
        )

    basic = F.lit(v.LDP_BASIC_CONTAINER)
    segment = F.col("c_mktsegment")
    customer_model = (
        F.when(segment == "BUILDING", F.lit(v.LDP_DIRECT_CONTAINER))
        .when(segment == "MACHINERY", F.lit(v.LDP_INDIRECT_CONTAINER))
        .otherwise(basic)
    )
    t = lambda name: table(spark, sf_dir, name)
    return _union(
        [
            rows(spark.range(1), F.lit("data:/"), basic, F.lit(None).cast("string"), F.lit(0)),
            rows(t("region"), _id("region", "r_regionkey"), basic, F.lit("data:/"), F.col("r_regionkey")),
            rows(t("nation"), _id("nation", "n_nationkey"), basic, _id("region", "n_regionkey"), F.col("n_nationkey")),
            rows(t("customer"), _id("customer", "c_custkey"), customer_model, _id("nation", "c_nationkey"), F.col("c_custkey")),
            rows(
                t("orders"),
                _id("order", "o_orderkey"),
                F.lit(v.LDP_RDF_SOURCE),
                _id("customer", "o_custkey"),
                F.col("o_orderkey"),
                modified=F.col("o_orderdate"),
                text=_order_text(),
            ),
            rows(
                t("documents"),
                _id("doc", "doc_id"),
                F.lit(v.LDP_NON_RDF_SOURCE),
                F.lit("data:/"),
                F.col("doc_id"),
                binary=F.concat(F.lit("s3://binaries/doc/"), F.col("doc_id").cast("string")),
                mime=F.lit("text/plain"),
                text=_document_text(),
            ),
        ]
    )


def resource_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Two batches of rows written over resources, and identifiers then deleted.

    A third of the customers move to the root a day after they were made; a
    day later a fifth are where they were, and no containers any more. Deleted
    are toxic documents and a seventh of the customers.
    """
    tree, key = resources(spark, sf_dir), F.col("seq")
    customers = tree.filter(F.col("identifier").startswith("data:/customer/"))
    moved = customers.filter(key % 3 == 0).withColumn("container", F.lit("data:/"))
    changed = customers.filter(key % 5 == 0).withColumn("interactionModel", F.lit(v.LDP_RDF_SOURCE))
    days = [df.withColumn("created", F.timestamp_add("DAY", F.lit(n), "created")) for n, df in ((1, moved), (2, changed))]
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select(_id("doc", "doc_id").alias("identifier"))
    return days[0], days[1], customers.filter(key % 7 == 0).select("identifier").unionByName(toxic)


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order and document, and for every part an id that does not exist."""
    return _union(
        [
            table(spark, sf_dir, "orders").select(_id("order", "o_orderkey").alias("identifier")),
            table(spark, sf_dir, "documents").select(_id("doc", "doc_id").alias("identifier")),
            table(spark, sf_dir, "part").select(_id("absent", "p_partkey").alias("identifier")),
        ]
    )


def quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quads of all orders, the server-managed ones included."""
    names = ("graph", "subject", "predicate", "object")
    made = [
        F.when(when, F.struct(*[term.alias(name) for name, term in zip(names, terms)]))
        for when, *terms in _order_quads(server=True)
    ]
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(_id("order", "o_orderkey").alias("identifier"), F.inline(F.array(*made)))
    return rows.filter("subject IS NOT NULL")


def nquads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts to parse: orders with noise and bad lines, and whole documents as literals."""
    subject = F.concat(F.lit("<data:/order/"), F.col("o_orderkey").cast("string"), F.lit(">"))
    priority = F.col("o_orderpriority")
    extra = (
        F.when(priority == "2-HIGH", F.lit("# a comment\n\n  \t# another"))
        .when(priority == "3-MEDIUM", F.concat(subject, F.lit(f' <{EX}status> "open <{DEFAULTS.user_graph}> .')))
        .when(priority == "5-LOW", F.lit(f'"literal subject" <{EX}p> <{EX}o> .'))
        .when(priority == "1-URGENT", F.concat(subject, F.lit(f'<{EX}flag>"yes"^^<{v.XSD_STRING}>. # tight'), F.lit("\r")))
    )
    orders = table(spark, sf_dir, "orders").select(
        _id("order", "o_orderkey").alias("identifier"),
        F.concat_ws("\n", _order_text(), extra).alias("quads"),
    )
    documents = table(spark, sf_dir, "documents").select(
        _id("doc", "doc_id").alias("identifier"), _document_text().alias("quads")
    )
    return orders.unionByName(documents)


def immutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit quad per order line; lines that repeat give the same quad again."""
    line = F.concat_ws(
        "",
        nq.iri_term(_id("order", "l_orderkey")),
        F.lit(f" <{EX}hasLine> <data:/order/"),
        F.col("l_orderkey").cast("string"),
        F.lit("/line/"),
        F.col("l_linenumber").cast("string"),
        F.lit(f"> <{DEFAULTS.audit_graph}> ."),
    )
    return table(spark, sf_dir, "lineitem").select(
        _id("order", "l_orderkey").alias("identifier"), F.col("l_shipdate").alias("created"), line.alias("quads")
    )


OPS_OF_TYPES = {"signup": "create", "purchase": "replace", "click": "touch", "error": "delete", "view": "add"}


def ops_of(events: DataFrame) -> DataFrame:
    """Events as ops on user resources; works on streams too."""
    kinds = F.create_map(*[F.lit(x) for pair in OPS_OF_TYPES.items() for x in pair])
    return events.select(
        kinds[F.col("event_type")].alias("op"),
        _id("user", "user_id").alias("identifier"),
        "ts",
        F.col("event_id").alias("seq"),
        "value",
    )


def ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops_of(table(spark, sf_dir, "events"))


def versions(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """A version of a user resource for every event.

    ``spread`` deals the events, whose files are few, to several tasks a core:
    for work that takes much longer than reading them.
    """
    user = F.col("user_id")
    null = F.lit(None).cast("string")

    def every(n: int, value: Column) -> Column:
        return F.when(user % n == 0, value).otherwise(null)

    def member(name: str) -> Column:
        return every(5, F.lit(EX + name))

    identifier = _id("user", "user_id")
    term = nq.iri_term(identifier)
    event = F.col("event_id").cast("string")
    # some name the graph by an escape
    audit = F.when(user % 9 == 0, F.lit(f"<{AUDIT_ESCAPED}>")).otherwise(F.lit(f"<{DEFAULTS.audit_graph}>"))
    lines = [
        nq.quad_line(term, _ex("event"), nq.literal_term(event), F.lit(f"<{DEFAULTS.user_graph}>")),
        F.when(user % 7 == 0, nq.quad_line(term, F.lit(f"<{ACL_MODE}>"), F.lit(f"<{ACL_READ}>"), F.lit(f"<{DEFAULTS.acl_graph}>"))),
        F.when(user % 3 == 0, nq.quad_line(term, _ex("audited"), nq.literal_term(F.col("event_type")), audit)),
    ]
    text = F.when(user % 11 != 0, F.concat_ws("\n", *lines))
    events = table(spark, sf_dir, "events")
    if spread:
        events = events.repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, "event_id")
    return events.select(
        identifier.alias("identifier"),
        F.when(user % 3 == 0, F.lit(v.LDP_NON_RDF_SOURCE)).otherwise(F.lit(v.LDP_RDF_SOURCE)).alias("interactionModel"),
        every(2, F.lit("data:/")).alias("container"),
        every(3, F.concat(F.lit("s3://binaries/user/"), user.cast("string"))).alias("binaryIdentifier"),
        F.lit("text/plain").alias("mimeType"),
        F.col("ts").alias("modified"),
        F.col("ts").alias("created"),
        F.col("event_id").alias("seq"),
        text.alias("quads"),
        times.truncate_seconds("ts").alias("mementomodified"),
        member("membershipResource").alias("membershipResource"),
        member("memberRelation").alias("memberRelation"),
        member("memberOfRelation").alias("memberOfRelation"),
        member("insertedContentRelation").alias("insertedContentRelation"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stood three days before each event; and per nation a user who never was."""
    asked = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("req"),
        _id("user", "user_id").alias("identifier"),
        (F.col("ts") - F.expr("INTERVAL '3' DAY")).alias("at"),
    )
    absent = table(spark, sf_dir, "nation").select(
        (-1 - F.col("n_nationkey")).cast("bigint").alias("req"),
        _id("user/absent", "n_nationkey").alias("identifier"),
        F.expr(START).alias("at"),
    )
    return asked.unionByName(absent)


VERSION_PREFIX = "mementos/"


def version_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version objects (key, meta, body) with every sort of key and missing attribute."""
    user, event = F.col("user_id"), F.col("event_id")
    far = F.when(event % 10 == 2, F.lit(FAR)).otherwise(F.lit(0))
    mark = (
        F.when(event % 10 == 0, F.lit("?version"))
        .when(event % 10 == 1, F.lit("?version=latest"))
        .otherwise(F.concat(F.lit("?version="), (F.unix_timestamp("ts") + far).cast("string")))
    )
    pairs = {
        v.META_MODEL: F.when(user % 4 != 0, F.lit(v.LDP_RDF_SOURCE)),
        v.META_MODIFIED: F.when(user % 13 != 0, times.format_instant("ts")),
        v.META_CONTAINER: F.when(user % 2 == 0, F.lit("data:/")),
        v.META_BINARY_LOCATION: F.when(user % 3 == 0, F.lit("s3://binaries/x")),
        v.META_BINARY_TYPE: F.when(user % 2 == 0, F.lit("text/plain")),
        v.META_MEMBERSHIP_RESOURCE: F.when(user % 5 == 0, F.lit(EX + "membershipResource")),
        v.META_MEMBER_RELATION: F.when(user % 5 == 0, F.lit(EX + "memberRelation")),
        v.META_MEMBER_OF_RELATION: F.when(user % 5 == 0, F.lit(EX + "memberOfRelation")),
        v.META_INSERTED_CONTENT: F.when(user % 5 == 0, F.lit(EX + "insertedContentRelation")),
        v.META_HAS_ACL: F.when(user % 7 == 0, F.lit("true")),
        v.META_GRAPHS: F.when(user % 11 == 0, F.lit("")).when(
            user % 11 < 9, F.lit(f"{DEFAULTS.audit_graph},{DEFAULTS.acl_graph}")
        ),
    }
    flat = [x for name, value in pairs.items() for x in (F.lit(name), value)]
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit(VERSION_PREFIX + "user/"), user.cast("string"), mark).alias("key"),
        F.map_filter(F.create_map(*flat), lambda _, value: value.isNotNull()).alias("meta"),
        F.lit(None).cast("string").alias("body"),
    )


def _binary_id() -> Column:
    return F.concat(F.lit("s3://binaries/doc/"), F.col("doc_id").cast("string"))


def binary_contents(spark: SparkSession, sf_dir: str, chunk_size: int = CHUNK) -> DataFrame:
    """Whole documents as bytes: identifier, content, chunkSize, mimeType, source."""
    return table(spark, sf_dir, "documents").select(
        _binary_id().alias("identifier"),
        F.encode("text", "UTF-8").alias("content"),
        F.lit(chunk_size).alias("chunkSize"),
        F.lit("text/plain").alias("mimeType"),
        "source",
    )


def hinted_binaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with chunk size hints of all sorts: identifier, content, hints."""
    hints = (
        F.when(F.col("source") == "src0", F.array(F.lit("1024"), F.lit("2048")))
        .when(F.col("source") == "src1", F.array(F.lit("0")))
        .when(F.col("source") == "src2", F.array(F.lit("large")))
        .when(F.col("source") == "src3", F.array().cast("array<string>"))
        .when(F.col("lang") == "de", F.array(F.lit("4096")))
    )
    return table(spark, sf_dir, "documents").select(
        _binary_id().alias("identifier"), F.encode("text", "UTF-8").alias("content"), hints.alias("hints")
    )


def chunks(spark: SparkSession, sf_dir: str, chunk_size: int = CHUNK) -> DataFrame:
    return binaries.chunk(binary_contents(spark, sf_dir, chunk_size))


def damaged_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with a gap (src3), no last one (src4), an old tail (src5), a short first one (src6), or one of an older write (src7)."""
    whole = binary_contents(spark, sf_dir)
    source = F.col("source")
    marked = binaries.chunk(whole.withColumn("identifier", F.struct("identifier", "source")))
    marked = marked.select("identifier.identifier", "identifier.source", "size", "chunkSize", "chunkIndex", "chunk")
    last = F.floor(F.col("size") / F.col("chunkSize"))
    kept = marked.filter(
        ~((source == "src3") & (F.col("chunkIndex") == 1)) & ~((source == "src4") & (F.col("chunkIndex") == last))
    )
    cut = F.when((source == "src6") & (F.col("chunkIndex") == 0), F.col("chunk").substr(F.lit(1), F.lit(5)))
    old = (source == "src7") & (F.col("chunkIndex") == 1)
    kept = kept.withColumn("size", F.when(old, F.col("size") + 7).otherwise(F.col("size")))
    kept = kept.withColumn("chunk", F.coalesce(cut, "chunk")).drop("source")
    size = F.octet_length("content")
    tail = whole.filter(source == "src5").select(
        "identifier",
        (size + CHUNK).cast("bigint").alias("size"),
        "chunkSize",
        (F.floor(size / CHUNK) + 1).cast("int").alias("chunkIndex"),
        F.lit(b"x").alias("chunk"),
    )
    return kept.unionByName(tail)


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ranges per document, some past its end; and per benchmark item one of an absent binary."""
    documents = table(spark, sf_dir, "documents")
    span = F.array(
        F.struct(F.lit(0).alias("k"), (F.col("doc_id") % 97).alias("a"), (F.col("doc_id") % 97 + 1_500).alias("b")),
        F.struct(F.lit(1).alias("k"), F.lit(1_000).cast("bigint").alias("a"), F.lit(1_100).cast("bigint").alias("b")),
        F.struct(F.lit(2).alias("k"), F.col("n_chars").alias("a"), (F.col("n_chars") + 10).alias("b")),
    )
    asked = documents.select("doc_id", F.inline(span)).select(
        (F.col("doc_id") * 3 + F.col("k")).alias("req"),
        _binary_id().alias("identifier"),
        F.col("a").alias("from"),
        F.col("b").alias("to"),
    )
    absent = table(spark, sf_dir, "benchmark").select(
        (-1 - F.col("item_id")).cast("bigint").alias("req"),
        F.concat(F.lit("s3://binaries/absent/"), F.col("item_id").cast("string")).alias("identifier"),
        F.lit(0).cast("bigint").alias("from"),
        F.lit(9).cast("bigint").alias("to"),
    )
    return asked.unionByName(absent)


def binary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's binary, and per benchmark item one that is absent."""
    absent = F.concat(F.lit("s3://binaries/absent/"), F.col("item_id").cast("string"))
    return (
        table(spark, sf_dir, "documents")
        .select(_binary_id().alias("identifier"))
        .unionByName(table(spark, sf_dir, "benchmark").select(absent.alias("identifier")))
    )


def iris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses as they are, spoilt, empty, null or with the binary scheme."""
    url, kind = F.col("url"), F.col("page_id") % 10
    iri = (
        F.when(kind == 0, F.concat(F.lit("bad iri "), url))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.lit(None).cast("string"))
        .when(kind == 3, F.concat(F.lit("s3://"), F.substring_index(url, "://", -1)))
        .otherwise(url)
    )
    return table(spark, sf_dir, "pages").select("page_id", iri.alias("iri"))


def notifications_of(events: DataFrame) -> DataFrame:
    """Events as notifications, one in twenty sent twice; works on streams too."""
    copies = F.when(F.col("event_id") % 20 == 0, 2).otherwise(1)
    return events.select(
        F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("id"),
        _id("user", "user_id").alias("object"),
        F.array(F.concat(F.lit("agent/"), (F.col("user_id") % 10).cast("string"))).alias("agents"),
        F.array("event_type").alias("types"),
        F.array(F.lit(v.LDP_RDF_SOURCE)).alias("objectTypes"),
        F.col("ts").alias("created"),
    ).drop("_copy")
