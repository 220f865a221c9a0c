"""DuckDB SQL for the registered queries, written from the given tables."""

from __future__ import annotations

from quadloom import vocab as v
from quadloom.plans.fixtures import ACL_MODE, ACL_READ, AUDIT_ESCAPED, EX, XSD_INTEGER
from quadloom.vocab import DEFAULTS

U, S, A, AUDIT = DEFAULTS.user_graph, DEFAULTS.server_graph, DEFAULTS.acl_graph, DEFAULTS.audit_graph
START = "TIMESTAMP '2024-01-01 00:00:00'"

_ORDER = "'<data:/order/' || o_orderkey || '>'"
_NOTE = """'"said \\"hi\\" to \\\\ customer ' || o_custkey || '"@en'"""
_DOC_LITERAL = (
    "'\"' || replace(replace(replace(replace(text, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r')"
    " || '\"@' || lang"
)
_ORDER_LINES = f"""
    {_ORDER} || ' <{EX}status> "' || o_orderstatus || '" <{U}> .',
    {_ORDER} || ' <{EX}priority> "' || o_orderpriority || '" <{U}> .',
    CASE WHEN o_orderpriority = '1-URGENT' THEN {_ORDER} || ' <{ACL_MODE}> <{ACL_READ}> <{A}> .' END,
    CASE WHEN o_orderpriority = '2-HIGH' THEN {_ORDER} || ' <{EX}customer> "' || o_custkey || '"^^<{XSD_INTEGER}> .' END,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED'
         THEN '_:b' || o_orderkey || ' <{EX}note> ' || {_NOTE} || ' _:g' || o_orderkey || ' .' END"""

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_own_quads": (
        (),
        f"""
        SELECT 'data:/order/' || o_orderkey AS identifier, '<{U}>' AS graph, {_ORDER} AS subject,
               '<{EX}status>' AS predicate, '"' || o_orderstatus || '"' AS object FROM orders
        UNION ALL SELECT 'data:/order/' || o_orderkey, '<{U}>', {_ORDER}, '<{EX}priority>', '"' || o_orderpriority || '"' FROM orders
        UNION ALL SELECT 'data:/order/' || o_orderkey, '<{A}>', {_ORDER}, '<{ACL_MODE}>', '<{ACL_READ}>' FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION ALL SELECT 'data:/order/' || o_orderkey, NULL, {_ORDER}, '<{EX}customer>', '"' || o_custkey || '"^^<{XSD_INTEGER}>' FROM orders WHERE o_orderpriority = '2-HIGH'
        UNION ALL SELECT 'data:/order/' || o_orderkey, '_:g' || o_orderkey, '_:b' || o_orderkey, '<{EX}note>', {_NOTE} FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'""",
    ),
    "fx_quads": (
        ("fx_own_quads",),
        f"""
        SELECT * FROM fx_own_quads
        UNION ALL SELECT 'data:/order/' || o_orderkey, '<{S}>', {_ORDER}, '<{v.RDF_TYPE}>', '<{v.LDP_RDF_SOURCE}>' FROM orders""",
    ),
    "fx_doc_quads": (
        (),
        f"""
        SELECT 'data:/doc/' || doc_id AS identifier, '<{U}>' AS graph, '<data:/doc/' || doc_id || '>' AS subject,
               '<http://purl.org/dc/terms/description>' AS predicate, {_DOC_LITERAL} AS object FROM documents""",
    ),
    "fx_resources": (
        ("fx_doc_quads",),
        f"""
        SELECT 'data:/' AS identifier, '{v.LDP_BASIC_CONTAINER}' AS interactionModel, CAST(NULL AS VARCHAR) AS container,
               CAST(NULL AS VARCHAR) AS binaryIdentifier, CAST(NULL AS VARCHAR) AS mimeType, {START} AS modified,
               CAST(NULL AS VARCHAR) AS quads, CAST(NULL AS VARCHAR) AS graphs
        UNION ALL SELECT 'data:/region/' || r_regionkey, '{v.LDP_BASIC_CONTAINER}', 'data:/', NULL, NULL, {START}, NULL, NULL FROM region
        UNION ALL SELECT 'data:/nation/' || n_nationkey, '{v.LDP_BASIC_CONTAINER}', 'data:/region/' || n_regionkey, NULL, NULL, {START}, NULL, NULL FROM nation
        UNION ALL SELECT 'data:/customer/' || c_custkey,
               CASE c_mktsegment WHEN 'BUILDING' THEN '{v.LDP_DIRECT_CONTAINER}' WHEN 'MACHINERY' THEN '{v.LDP_INDIRECT_CONTAINER}'
                    ELSE '{v.LDP_BASIC_CONTAINER}' END,
               'data:/nation/' || c_nationkey, NULL, NULL, {START}, NULL, NULL FROM customer
        UNION ALL SELECT 'data:/order/' || o_orderkey, '{v.LDP_RDF_SOURCE}', 'data:/customer/' || o_custkey, NULL, NULL, o_orderdate,
               concat_ws(chr(10), {_ORDER_LINES}), CASE WHEN o_orderpriority = '1-URGENT' THEN '{A}' END FROM orders
        UNION ALL SELECT identifier, '{v.LDP_NON_RDF_SOURCE}', 'data:/', replace(identifier, 'data:/', 's3://binaries/'), 'text/plain', {START},
               subject || ' ' || predicate || ' ' || object || ' ' || graph || ' .', NULL FROM fx_doc_quads""",
    ),
    "fx_ids": (
        (),
        """
        SELECT 'data:/order/' || o_orderkey AS identifier FROM orders
        UNION ALL SELECT 'data:/doc/' || doc_id FROM documents
        UNION ALL SELECT 'data:/absent/' || p_partkey FROM part""",
    ),
    "fx_containment": (
        ("fx_resources",),
        f"""
        SELECT container AS identifier, '<{v.PREFER_CONTAINMENT}>' AS graph,
               CASE WHEN right(container, 1) = '/' THEN '<' || container || '>' ELSE '<' || container || '/>' END AS subject,
               '<{v.LDP_CONTAINS}>' AS predicate,
               CASE WHEN interactionModel LIKE '%Container' AND right(identifier, 1) <> '/' THEN '<' || identifier || '/>'
                    ELSE '<' || identifier || '>' END AS object
        FROM fx_resources WHERE container IS NOT NULL""",
    ),
    "fx_audit": (
        (),
        f"""
        SELECT 'data:/order/' || l_orderkey AS identifier, l_shipdate AS created, '<{AUDIT}>' AS graph,
               '<data:/order/' || l_orderkey || '>' AS subject, '<{EX}hasLine>' AS predicate,
               '<data:/order/' || l_orderkey || '/line/' || l_linenumber || '>' AS object FROM lineitem""",
    ),
    "fx_versions": (
        (),
        f"""
        SELECT 'data:/user/' || user_id AS identifier, user_id, event_id AS seq, event_type, ts AS modified,
               date_trunc('second', ts) AS version,
               CASE WHEN user_id % 3 = 0 THEN '{v.LDP_NON_RDF_SOURCE}' ELSE '{v.LDP_RDF_SOURCE}' END AS interactionModel,
               CASE WHEN user_id % 2 = 0 THEN 'data:/' END AS container,
               CASE WHEN user_id % 3 = 0 THEN 's3://binaries/user/' || user_id END AS binaryIdentifier,
               CASE WHEN user_id % 11 <> 0 THEN concat_ws(chr(10),
                    '<data:/user/' || user_id || '> <{EX}event> "' || event_id || '" <{U}> .',
                    CASE WHEN user_id % 7 = 0 THEN '<data:/user/' || user_id || '> <{ACL_MODE}> <{ACL_READ}> <{A}> .' END,
                    CASE WHEN user_id % 3 = 0 THEN '<data:/user/' || user_id || '> <{EX}audited> "' || event_type || '" <' ||
                         CASE WHEN user_id % 9 = 0 THEN '{AUDIT_ESCAPED}' ELSE '{AUDIT}' END || '> .' END
               ) END AS quads,
               CASE WHEN user_id % 11 <> 0 THEN concat_ws(',', CASE WHEN user_id % 7 = 0 THEN '{A}' END,
                    CASE WHEN user_id % 3 = 0 THEN '{AUDIT}' END) ELSE '' END AS graphs
        FROM events""",
    ),
    "fx_requests": (
        (),
        f"""
        SELECT event_id AS req, 'data:/user/' || user_id AS identifier, ts - INTERVAL 3 DAY AS asked FROM events
        UNION ALL SELECT -1 - n_nationkey, 'data:/user/absent/' || n_nationkey, {START} FROM nation""",
    ),
    "fx_version_at": (
        ("fx_versions", "fx_requests"),
        """
        SELECT r.req, r.identifier,
               coalesce(max(w.version) FILTER (WHERE w.version <= date_trunc('second', r.asked)), min(w.version)) AS version,
               count(w.version) > 0 AS found
        FROM fx_requests r LEFT JOIN fx_versions w ON r.identifier = w.identifier GROUP BY r.req, r.identifier""",
    ),
    "fx_version_at_objects": (
        ("fx_versions", "fx_requests"),
        """
        SELECT r.req, r.identifier,
               coalesce(max(w.version) FILTER (WHERE w.version <= date_trunc('second', r.asked)), min(w.version)) AS version,
               count(w.version) > 0 AS found
        FROM fx_requests r LEFT JOIN (SELECT identifier, CASE WHEN seq % 10 = 2 THEN version + INTERVAL 100000000000 SECOND ELSE version END AS version
            FROM fx_versions WHERE seq % 10 NOT IN (0, 1)) w ON r.identifier = w.identifier
        GROUP BY r.req, r.identifier""",
    ),
    "fx_objects": (
        (),
        """
        SELECT user_id, event_id, ts, 'mementos/user/' || user_id || CASE event_id % 10 WHEN 0 THEN '?version' WHEN 1 THEN '?version=latest'
               WHEN 2 THEN '?version=' || (CAST(epoch(date_trunc('second', ts)) AS BIGINT) + 100000000000)
               ELSE '?version=' || CAST(epoch(date_trunc('second', ts)) AS BIGINT) END AS key
        FROM events""",
    ),
    "fx_ops": (
        (),
        """
        SELECT CASE event_type WHEN 'signup' THEN 'create' WHEN 'purchase' THEN 'replace' WHEN 'click' THEN 'touch'
                    WHEN 'error' THEN 'delete' ELSE 'add' END AS op,
               'data:/user/' || user_id AS identifier, ts, event_id AS seq, value FROM events""",
    ),
    "fx_fold": (
        ("fx_ops",),
        """
        SELECT identifier, value, modified, created, seq FROM (
            SELECT identifier,
                   arg_max(value, seq_key) FILTER (WHERE op IN ('create', 'replace')) AS value,
                   arg_max(ts, seq_key) FILTER (WHERE op IN ('create', 'replace', 'touch')) AS modified,
                   arg_max(ts, seq_key) FILTER (WHERE op IN ('create', 'replace')) AS created,
                   arg_max(seq, seq_key) FILTER (WHERE op IN ('create', 'replace')) AS seq,
                   max(seq_key) FILTER (WHERE op IN ('create', 'replace')) AS w,
                   max(seq_key) FILTER (WHERE op = 'delete') AS d
            FROM (SELECT *, row_number() OVER (ORDER BY ts, seq) AS seq_key FROM fx_ops) GROUP BY identifier)
        WHERE w IS NOT NULL AND (d IS NULL OR w > d)""",
    ),
    "fx_binaries": (
        (),
        """
        SELECT 's3://binaries/doc/' || doc_id AS identifier, doc_id, n_chars, source, lang, text, hex(encode(text)) AS h, strlen(text) AS n
        FROM documents""",
    ),
    "fx_ranges": (
        (),
        """
        SELECT doc_id * 3 AS req, 's3://binaries/doc/' || doc_id AS identifier, doc_id % 97 AS a, doc_id % 97 + 1500 AS b FROM documents
        UNION ALL SELECT doc_id * 3 + 1, 's3://binaries/doc/' || doc_id, 1000, 1100 FROM documents
        UNION ALL SELECT doc_id * 3 + 2, 's3://binaries/doc/' || doc_id, n_chars, n_chars + 10 FROM documents
        UNION ALL SELECT -1 - item_id, 's3://binaries/absent/' || item_id, 0, 9 FROM benchmark""",
    ),
    "fx_binary_ids": (
        (),
        """
        SELECT 's3://binaries/doc/' || doc_id AS identifier FROM documents
        UNION ALL SELECT 's3://binaries/absent/' || item_id FROM benchmark""",
    ),
    "fx_iris": (
        (),
        """
        SELECT page_id, CASE page_id % 10 WHEN 0 THEN 'bad iri ' || url WHEN 1 THEN '' WHEN 2 THEN NULL
               WHEN 3 THEN 's3://' || split_part(url, '://', 2) ELSE url END AS iri FROM pages""",
    ),
    "fx_toxic": ((), "SELECT doc_id FROM labels WHERE toxic = 1"),
    "fx_changed": (
        ("fx_resources",),
        f"""
        SELECT identifier, CASE WHEN k % 5 = 0 THEN '{v.LDP_RDF_SOURCE}' ELSE interactionModel END AS interactionModel,
               CASE WHEN k % 3 = 0 AND k % 5 <> 0 THEN 'data:/' ELSE container END AS container, modified, k
        FROM (SELECT *, CASE WHEN identifier LIKE 'data:/customer/%' THEN CAST(split_part(identifier, '/', 3) AS BIGINT) END AS k FROM fx_resources)""",
    ),
    "fx_left": (
        ("fx_changed", "fx_toxic"),
        """
        SELECT identifier, interactionModel, container, modified FROM fx_changed
        WHERE coalesce(k % 7 <> 0, true) AND identifier NOT IN (SELECT 'data:/doc/' || doc_id FROM fx_toxic)""",
    ),
}


def _with(body: str, *names: str) -> str:
    """``body`` after the common tables it names and those they need."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in CTES[name][0]:
            need(other)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    listed = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {listed}\n{body}" if order else body


def _chunks(size: int) -> str:
    return f"""
        SELECT identifier, CAST(n AS BIGINT) AS size, {size} AS chunkSize, CAST(i AS INTEGER) AS chunkIndex,
               substr(h, 2 * {size} * i + 1, 2 * {size}) AS chunk
        FROM (SELECT *, unnest(range(0, n // {size} + 1)) AS i FROM fx_binaries)"""


def _slice(a: str, b: str) -> str:
    """Hex of bytes a to b, both included, none when b < a."""
    return f"substr(b.h, 2 * ({a}) + 1, greatest(2 * (({b}) - ({a}) + 1), 0))"


_RANGE_JOIN = "FROM fx_ranges r LEFT JOIN fx_binaries b ON r.identifier = b.identifier"
_TYPED = (
    f"SELECT identifier, '<{S}>' AS graph, '<' || identifier || '>' AS subject, '<{v.RDF_TYPE}>' AS predicate,"
    " '<' || interactionModel || '>' AS object"
)
_NEWEST_PER = """
        SELECT identifier, {unit} AS version, max(modified) AS modified, arg_max(seq, modified) AS seq,
               any_value(container) AS container, arg_max(quads, modified) AS quads
        FROM fx_versions GROUP BY identifier, {unit}"""
_ONE = """
        SELECT identifier, {pick}(modified) AS modified, {pick}(modified) AS created, arg_{pick}(seq, modified) AS seq,
               any_value(interactionModel) AS interactionModel, arg_{pick}(quads, modified) AS quads
        FROM fx_versions GROUP BY identifier"""
_ISO = (
    "strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN date_part('microsecond', {ts}) % 1000000 = 0 THEN ''"
    " WHEN date_part('microsecond', {ts}) % 1000 = 0 THEN '.' || substr(strftime({ts}, '%f'), 1, 3)"
    " ELSE '.' || strftime({ts}, '%f') END || 'Z'"
)
_VERSION_KEY = "'mementos/' || substr(identifier, 7) || '?version=' || CAST(epoch(version) AS BIGINT)"


def _member(name: str) -> str:
    return f"CASE WHEN user_id % 5 = 0 THEN '{EX}{name}' END"


_MEMBERSHIP = ", ".join(
    f"{_member(n)} AS {n}" for n in ("membershipResource", "memberRelation", "memberOfRelation", "insertedContentRelation")
)

ORACLES: dict[str, str] = {
    "nquads_ingest": _with(
        f"""SELECT * FROM fx_own_quads UNION SELECT * FROM fx_doc_quads
        UNION SELECT 'data:/order/' || o_orderkey, NULL, {_ORDER}, '<{EX}flag>', '"yes"' FROM orders WHERE o_orderpriority = '1-URGENT'""",
        "fx_own_quads",
        "fx_doc_quads",
    ),
    "nquads_quarantine": f"""
        SELECT 'data:/order/' || o_orderkey AS identifier, {_ORDER} || ' <{EX}status> "open <{U}> .' AS line FROM orders WHERE o_orderpriority = '3-MEDIUM'
        UNION ALL SELECT 'data:/order/' || o_orderkey, '"literal subject" <{EX}p> <{EX}o> .' FROM orders WHERE o_orderpriority = '5-LOW'""",
    "nquads_emit": _with(
        """SELECT i.identifier, 0 AS part, string_agg(DISTINCT concat_ws(' ', q.subject, q.predicate, q.object, q.graph, '.'), chr(10)
                  ORDER BY concat_ws(' ', q.subject, q.predicate, q.object, q.graph, '.')) FILTER (WHERE q.subject IS NOT NULL) AS quads
        FROM fx_ids i LEFT JOIN fx_own_quads q ON i.identifier = q.identifier GROUP BY i.identifier""",
        "fx_ids",
        "fx_own_quads",
    ),
    "nquads_files": _with("SELECT graph, subject, predicate, object FROM fx_quads", "fx_quads"),
    "graph_filter": _with(f"SELECT * FROM fx_quads WHERE graph IN ('<{U}>', '<{A}>')", "fx_quads"),
    "graph_exclude": _with(f"SELECT * FROM fx_quads WHERE graph IS NULL OR graph NOT IN ('<{U}>', '<{S}>')", "fx_quads"),
    "metadata_graphs": _with(
        f"""SELECT DISTINCT identifier, '{A}' AS graph FROM fx_quads WHERE graph = '<{A}>'
        UNION SELECT container, '{v.PREFER_CONTAINMENT}' FROM fx_resources WHERE container IS NOT NULL""",
        "fx_quads",
        "fx_resources",
    ),
    "metadata_graphs_object": f"SELECT 'data:/order/' || o_orderkey AS identifier, '{A}' AS graph FROM orders WHERE o_orderpriority = '1-URGENT'",
    "typed_quads": _with(f"{_TYPED} FROM fx_resources", "fx_resources"),
    "assemble_resource": _with(
        f"""SELECT * FROM fx_own_quads UNION SELECT * FROM fx_doc_quads
        UNION SELECT identifier, graph, subject, predicate, object FROM fx_audit
        UNION SELECT * FROM fx_containment UNION {_TYPED} FROM fx_resources""",
        "fx_own_quads",
        "fx_doc_quads",
        "fx_audit",
        "fx_containment",
        "fx_resources",
    ),
    "assemble_ids": _with(
        f"""SELECT * FROM (SELECT * FROM fx_own_quads UNION SELECT * FROM fx_doc_quads
        UNION SELECT identifier, graph, subject, predicate, object FROM fx_audit
        UNION SELECT * FROM fx_containment UNION {_TYPED} FROM fx_resources)
        WHERE identifier IN (SELECT identifier FROM fx_ids)""",
        "fx_own_quads",
        "fx_doc_quads",
        "fx_audit",
        "fx_containment",
        "fx_resources",
        "fx_ids",
    ),
    "assemble_ids_index": _with(
        f"""SELECT * FROM (SELECT * FROM fx_containment UNION {_TYPED} FROM fx_resources)
        WHERE identifier LIKE 'data:/customer/%'""",
        "fx_containment",
        "fx_resources",
    ),
    "immutable_quads": _with("SELECT DISTINCT identifier, graph, subject, predicate, object FROM fx_audit", "fx_audit"),
    "resource_lookup": _with(
        """SELECT i.identifier, r.identifier IS NOT NULL AS found, r.interactionModel, r.container, r.modified, r.quads
        FROM fx_ids i LEFT JOIN fx_resources r ON i.identifier = r.identifier""",
        "fx_ids",
        "fx_resources",
    ),
    "metadata_projection": _with(
        """SELECT identifier, interactionModel, container, modified, binaryIdentifier,
                  CASE WHEN binaryIdentifier IS NOT NULL THEN mimeType END AS mimeType, coalesce(graphs, '') AS metadataGraphs
        FROM fx_resources""",
        "fx_resources",
    ),
    "model_check": _with(
        f"""SELECT identifier, interactionModel, interactionModel NOT IN ('{v.LDP_DIRECT_CONTAINER}', '{v.LDP_INDIRECT_CONTAINER}') AS accepted
        FROM fx_resources""",
        "fx_resources",
    ),
    "containment": _with("SELECT * FROM fx_containment", "fx_containment"),
    "containment_index": _with("SELECT container, identifier, interactionModel FROM fx_resources WHERE container IS NOT NULL", "fx_resources"),
    "ready_probe": "SELECT count(*) > 0 AS ready FROM (SELECT 1 FROM orders UNION ALL SELECT 1 FROM documents UNION ALL SELECT 1)",
    "upsert_state": _with(
        """SELECT identifier, value, ts AS created, seq FROM fx_ops
        QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY ts DESC, seq DESC) = 1""",
        "fx_ops",
    ),
    "delete_state": _with(
        """SELECT identifier, interactionModel, container, modified FROM fx_resources
        WHERE identifier NOT IN (SELECT 'data:/doc/' || doc_id FROM fx_toxic)""",
        "fx_resources",
        "fx_toxic",
    ),
    "touch_state": _with(
        """SELECT r.identifier, r.interactionModel, greatest(t.ts, r.modified) AS modified FROM fx_resources r
        LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS ts FROM lineitem GROUP BY l_orderkey) t ON r.identifier = 'data:/order/' || t.l_orderkey""",
        "fx_resources",
    ),
    "touch_missed": "SELECT 'data:/part/' || l_partkey AS identifier, count(*) AS touches FROM lineitem GROUP BY l_partkey",
    "append_immutable": _with(
        f"""SELECT identifier, created, subject || ' ' || predicate || ' ' || object || ' ' || graph || ' .' AS quads FROM fx_audit
        UNION ALL SELECT identifier, ts, '<' || identifier || '> <{EX}viewed> "' || seq || '" <{AUDIT}> .' FROM fx_ops WHERE op = 'add'""",
        "fx_audit",
        "fx_ops",
    ),
    "fold_ops": _with("SELECT * FROM fx_fold", "fx_fold"),
    "ensure_root": _with("SELECT identifier, interactionModel, container, modified FROM fx_resources", "fx_resources"),
    "snapshot_versions": _with(
        "SELECT identifier, value, modified, date_trunc('second', modified) AS mementomodified, created, seq FROM fx_fold", "fx_fold"
    ),
    "version_list": _with("SELECT DISTINCT identifier, version FROM fx_versions ORDER BY identifier, version", "fx_versions"),
    "version_at": _with("SELECT * FROM fx_version_at", "fx_version_at"),
    "version_at_objects": _with("SELECT * FROM fx_version_at_objects", "fx_version_at_objects"),
    "version_dedup": _with(_NEWEST_PER.format(unit="version"), "fx_versions"),
    "version_dedup_day": _with(
        _NEWEST_PER.format(unit="CAST(date_trunc('day', modified) AS TIMESTAMP)"), "fx_versions"
    ),
    "first_version": _with(_ONE.format(pick="min"), "fx_versions"),
    "latest_version": _with(_ONE.format(pick="max"), "fx_versions"),
    "version_quads": _with(
        f""", chosen AS (
            SELECT a.req, w.* FROM fx_version_at a
            JOIN (SELECT * FROM fx_versions QUALIFY row_number() OVER (PARTITION BY identifier, version ORDER BY modified DESC, seq DESC) = 1) w
            ON a.identifier = w.identifier AND a.version = w.version)
        SELECT req, identifier, '<{U}>' AS graph, '<' || identifier || '>' AS subject, '<{EX}event>' AS predicate, '"' || seq || '"' AS object
        FROM chosen WHERE user_id % 11 <> 0
        UNION SELECT req, identifier, '<{A}>', '<' || identifier || '>', '<{ACL_MODE}>', '<{ACL_READ}>' FROM chosen WHERE user_id % 11 <> 0 AND user_id % 7 = 0
        UNION SELECT req, identifier, '<{AUDIT}>', '<' || identifier || '>', '<{EX}audited>', '"' || event_type || '"' FROM chosen WHERE user_id % 11 <> 0 AND user_id % 3 = 0
        UNION SELECT req, identifier, '<{S}>', '<' || identifier || '>', '<{v.RDF_TYPE}>', '<' || interactionModel || '>' FROM chosen""",
        "fx_version_at",
    ),
    "version_rows": _with(
        f"""SELECT a.req, a.identifier, a.version, w.interactionModel, w.container, w.binaryIdentifier, w.modified, w.quads,
               CASE WHEN w.user_id % 5 = 0 THEN '{EX}membershipResource' END AS membershipResource
        FROM fx_version_at a
        LEFT JOIN (SELECT * FROM fx_versions QUALIFY row_number() OVER (PARTITION BY identifier, version ORDER BY modified DESC, seq DESC) = 1) w
        ON a.identifier = w.identifier AND a.version = w.version""",
        "fx_version_at",
    ),
    "version_keys": _with(f"SELECT identifier, modified, {_VERSION_KEY} AS key FROM fx_versions", "fx_versions"),
    "version_catalog": """
        SELECT DISTINCT 'data:/user/' || user_id AS identifier,
               date_trunc('second', ts) + CASE WHEN event_id % 10 = 2 THEN INTERVAL 100000000000 SECOND ELSE INTERVAL 0 SECOND END AS version
        FROM events WHERE event_id % 10 NOT IN (0, 1)""",
    "version_catalog_rejects": "SELECT 'mementos/user/' || user_id || '?version=latest' AS key FROM events WHERE event_id % 10 = 1",
    "version_meta_encode": _with(
        f"""SELECT {_VERSION_KEY} AS key, concat_ws('|',
               'binaryLocation=' || binaryIdentifier,
               CASE WHEN binaryIdentifier IS NOT NULL THEN 'binaryMimeType=text/plain' END,
               'container=' || container,
               'hasMemberRelation=' || {_member("memberRelation")},
               'insertedContentRelation=' || {_member("insertedContentRelation")},
               'interactionModel=' || interactionModel,
               'isMemberOfRelation=' || {_member("memberOfRelation")},
               'membershipResource=' || {_member("membershipResource")},
               'metadataGraphs=' || CASE WHEN graphs = '{A},{AUDIT}' THEN '{A},{AUDIT}' ELSE graphs END,
               'modified=' || {_ISO.format(ts="modified")}) AS meta, quads AS body
        FROM fx_versions""",
        "fx_versions",
    ),
    "version_meta_decode": _with(
        f"""SELECT 'data:/user/' || user_id || CASE WHEN event_id % 10 = 0 THEN '?version' ELSE '' END AS identifier,
               CASE WHEN event_id % 10 = 2 THEN date_trunc('second', ts) + INTERVAL 100000000000 SECOND
                    WHEN event_id % 10 NOT IN (0, 1) THEN date_trunc('second', ts) END AS version,
               CASE WHEN user_id % 4 <> 0 THEN '{v.LDP_RDF_SOURCE}' ELSE '{v.LDP_RESOURCE}' END AS interactionModel,
               CASE WHEN user_id % 13 <> 0 THEN ts END AS modified,
               CASE WHEN user_id % 2 = 0 THEN 'data:/' END AS container,
               CASE WHEN user_id % 3 = 0 THEN 's3://binaries/x' END AS binaryIdentifier,
               CASE WHEN user_id % 6 = 0 THEN 'text/plain' END AS mimeType,
               {_MEMBERSHIP},
               CASE WHEN user_id % 7 = 0 THEN '{A}' WHEN user_id % 11 = 0 OR user_id % 11 >= 9 THEN '' ELSE '{A}|{AUDIT}' END AS metadataGraphs
        FROM fx_objects""",
        "fx_objects",
    ),
    "version_meta_roundtrip": _with(
        f"""SELECT identifier, version, interactionModel, modified, container, binaryIdentifier,
               CASE WHEN binaryIdentifier IS NOT NULL THEN 'text/plain' END AS mimeType, {_MEMBERSHIP},
               replace(graphs, ',', '|') AS metadataGraphs, quads
        FROM fx_versions""",
        "fx_versions",
    ),
    "membership_projection": _with(
        f"SELECT identifier, modified, {_MEMBERSHIP} FROM fx_versions", "fx_versions"
    ),
    "versioning_off": _with(
        "SELECT req, identifier, CAST(NULL AS TIMESTAMP) AS version, false AS found FROM fx_requests", "fx_requests"
    ),
    "chunk_binary": _with(_chunks(1024), "fx_binaries"),
    "chunk_binary_small": _with(_chunks(16), "fx_binaries"),
    "chunk_size_hint": _with(
        """SELECT identifier,
               CAST(CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN NULL WHEN lang = 'de' THEN 4096 ELSE 1024 END AS INTEGER) AS chunkSize,
               CASE source WHEN 'src0' THEN 'too many chunk sizes' WHEN 'src1' THEN 'chunk size below 1'
                    WHEN 'src2' THEN 'not a number' WHEN 'src3' THEN 'no chunk size' END AS error
        FROM fx_binaries""",
        "fx_binaries",
    ),
    "chunk_size_lookup": _with(
        """SELECT identifier, CAST(CASE WHEN identifier LIKE '%/doc/%' THEN 1024 END AS INTEGER) AS chunkSize,
               CASE WHEN identifier NOT LIKE '%/doc/%' THEN 'missing binary ' || identifier END AS error FROM fx_binary_ids""",
        "fx_binary_ids",
    ),
    "set_content": _with(
        """SELECT identifier, CAST(n AS BIGINT) AS size, CAST(c AS INTEGER) AS chunkSize, CAST(i AS INTEGER) AS chunkIndex,
               substr(h, 2 * c * i + 1, 2 * c) AS chunk
        FROM (SELECT *, unnest(range(0, n // c + 1)) AS i FROM (SELECT *, CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN 1024
              WHEN lang = 'de' THEN 4096 ELSE 2048 END AS c FROM fx_binaries))""",
        "fx_binaries",
    ),
    "set_content_rejects": _with(
        "SELECT identifier, 'no usable chunk size' AS reason FROM fx_binaries WHERE source IN ('src0', 'src1', 'src2', 'src3')",
        "fx_binaries",
    ),
    "object_digest": _with("SELECT identifier, CAST(n AS BIGINT) AS bytes, md5(text) AS md5 FROM fx_binaries", "fx_binaries"),
    "chunk_files": """
        WITH files AS (SELECT source, doc_id % 8 AS lot, hex(encode(string_agg(text || chr(10), '' ORDER BY doc_id))) AS h
                       FROM documents GROUP BY ALL)
        SELECT source, CAST(lot AS BIGINT) AS lot, CAST(length(h) // 2 AS BIGINT) AS size, CAST(65536 AS INTEGER) AS chunkSize,
               CAST(i AS INTEGER) AS chunkIndex, md5(unhex(substr(h, 131072 * i + 1, 131072))) AS md5
        FROM (SELECT *, unnest(range(0, length(h) // 131072 + 1)) AS i FROM files)""",
    "read_all": _with(
        """SELECT i.identifier, CAST(CASE WHEN b.h IS NOT NULL THEN 0 END AS INTEGER) AS segment, b.h AS content, b.h IS NOT NULL AS found
        FROM fx_binary_ids i LEFT JOIN fx_binaries b ON i.identifier = b.identifier""",
        "fx_binary_ids",
        "fx_binaries",
    ),
    "read_all_segments": _with(
        """SELECT identifier, CAST(s AS INTEGER) AS segment, substr(h, 2 * 4096 * s + 1, 2 * 4096) AS content
        FROM (SELECT *, unnest(range(0, greatest((n + 4095) // 4096, 1))) AS s FROM fx_binaries)""",
        "fx_binaries",
    ),
    "binary_digest": _with(
        """, leaves AS (SELECT identifier, any_value(n) AS n, any_value(text) AS text,
               string_agg(md5(unhex(substr(h, 2048 * i + 1, 2048))), '' ORDER BY i) AS joined
               FROM (SELECT *, unnest(range(0, n // 1024 + 1)) AS i FROM fx_binaries) GROUP BY identifier)
        SELECT identifier, CAST(n AS BIGINT) AS bytes, md5(md5(md5(joined))) AS tree_md5 FROM leaves""",
        "fx_binaries",
    ),
    "read_range": _with(
        f"SELECT r.req, r.identifier, 0 AS segment, {_slice('r.a', 'r.b')} AS content, b.h IS NOT NULL AS found {_RANGE_JOIN}",
        "fx_ranges",
        "fx_binaries",
    ),
    "read_range_small": _with(
        f"""SELECT r.req, r.identifier, CAST(s AS INTEGER) AS segment,
               {_slice('greatest(r.a, lo)', 'least(r.b, lo + 511)')} AS content, b.h IS NOT NULL AS found
        FROM (SELECT r.*, s, r.a // 16 * 16 + 512 * s AS lo FROM fx_ranges r, range(0, 4) t(s)) r
        LEFT JOIN fx_binaries b ON r.identifier = b.identifier
        WHERE s = 0 OR (b.n > lo AND r.b >= lo)""",
        "fx_ranges",
        "fx_binaries",
    ),
    "read_range_object": _with(
        f"SELECT r.req, r.identifier, {_slice('r.a', 'r.b')} AS content, b.h IS NOT NULL AS found {_RANGE_JOIN}",
        "fx_ranges",
        "fx_binaries",
    ),
    "purge_binary": _with(
        """SELECT identifier, CAST(i AS INTEGER) AS chunkIndex, CAST(least(1024, n - 1024 * i) AS INTEGER) AS bytes
        FROM (SELECT *, unnest(range(0, n // 1024 + 1)) AS i FROM fx_binaries WHERE doc_id NOT IN (SELECT doc_id FROM fx_toxic))""",
        "fx_binaries",
        "fx_toxic",
    ),
    "chunk_audit": _with(
        """SELECT identifier,
               CAST(n // 1024 + 1 - CASE WHEN source = 'src3' AND n >= 1024 THEN 1 WHEN source = 'src4' THEN 1 ELSE 0 END
                    + CASE WHEN source = 'src5' THEN 1 ELSE 0 END AS BIGINT) AS chunks,
               CAST(CASE WHEN source IN ('src3', 'src7') AND n >= 1024 THEN 1 WHEN source = 'src4' THEN 1 ELSE 0 END AS BIGINT) AS missing,
               CAST(CASE WHEN source = 'src6' AND n > 5 THEN 1 ELSE 0 END AS BIGINT) AS wrong_size,
               CAST(CASE WHEN source = 'src5' OR source = 'src7' AND n >= 1024 THEN 1 ELSE 0 END AS BIGINT) AS stale
        FROM fx_binaries WHERE NOT (source = 'src4' AND n < 1024)""",
        "fx_binaries",
    ),
    "missing_chunks": _with(
        """SELECT identifier, 1 AS chunkIndex FROM fx_binaries WHERE source IN ('src3', 'src7') AND n >= 1024
        UNION ALL SELECT identifier, CAST(n // 1024 AS INTEGER) FROM fx_binaries WHERE source = 'src4' AND n >= 1024""",
        "fx_binaries",
    ),
    "object_put": _with(
        "SELECT 'store/' || substr(identifier, 6) AS key, h || CASE WHEN source = 'src1' THEN '32' ELSE '' END AS content, 'text/plain' AS mimeType FROM fx_binaries",
        "fx_binaries",
    ),
    "binary_keys": _with(
        """SELECT page_id, CASE WHEN starts_with(iri, 's3://') THEN 'store/' || substr(iri, 6) END AS key,
               iri IS NOT NULL AND NOT starts_with(iri, 's3://') AS rejected FROM fx_iris""",
        "fx_iris",
    ),
    "iri_audit": _with(
        """SELECT page_id, nullif(iri, '') AS iri,
               CASE WHEN iri IS NULL OR iri = '' THEN 'null' WHEN contains(iri, ' ') THEN 'invalid' ELSE 'valid' END AS status FROM fx_iris""",
        "fx_iris",
    ),
    "text_bytes": "SELECT doc_id, hex(encode(text)) AS content, text FROM documents",
    "instants": f"""
        SELECT event_id, date_trunc('second', ts) AS truncated, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch,
               date_trunc('second', ts) AS from_epoch, {_ISO.format(ts="ts")} AS text, ts AS parsed FROM events""",
    "minted_ids": _with("SELECT identifier, true AS well_formed FROM fx_resources", "fx_resources"),
    "minted_ids_check": _with(
        "SELECT count(*) AS minted, count(*) AS distinct_ids, count(*) AS well_formed FROM fx_resources", "fx_resources"
    ),
    "table_lookup": _with(
        """SELECT r.identifier, interactionModel, container, modified FROM fx_resources r
        WHERE r.identifier IN (SELECT identifier FROM fx_ids)""",
        "fx_resources",
        "fx_ids",
    ),
    "stream_notifications": f"""
        SELECT 'event/' || event_id AS id,
               '{{"id":"event/' || event_id || '","object":"data:/user/' || user_id || '","agents":["agent/' || user_id % 10
               || '"],"types":["' || event_type || '"],"objectTypes":["{v.LDP_RDF_SOURCE}"],"created":"'
               || {_ISO.format(ts="ts")} || '"}}' AS message,
               CASE WHEN event_id % 10 = 7 THEN 'refused by the topic' END AS reason
        FROM (SELECT *, unnest(range(0, CASE WHEN event_id % 20 = 0 THEN 2 ELSE 1 END)) FROM events)""",
    "stream_ops": _with("SELECT * FROM fx_fold", "fx_fold"),
    "stream_versions": _with(
        """SELECT identifier, ts AS "at", CASE WHEN op = 'add' THEN 'addition' ELSE 'version' END AS kind
        FROM fx_ops WHERE op IN ('create', 'replace', 'add')""",
        "fx_ops",
    ),
    "stream_dedup": f"""
        SELECT 'event/' || event_id AS id, 'data:/user/' || user_id AS object, 'agent/' || user_id % 10 AS agents, event_type AS types,
               '{v.LDP_RDF_SOURCE}' AS "objectTypes", ts AS created FROM events""",
}

# The same quads, whichever store the versions come from.
ORACLES["version_quads_objects"] = ORACLES["version_quads"]
ORACLES["assemble_stored"] = ORACLES["assemble_ids"]
ORACLES["version_at_stored"] = ORACLES["version_at"]
ORACLES["store_purge"] = ORACLES["purge_binary"]
ORACLES["store_state"] = _with("SELECT * FROM fx_left", "fx_left")
ORACLES["store_snapshot"] = _with("SELECT identifier, interactionModel, container, modified FROM fx_changed", "fx_changed")
ORACLES["containment_view"] = _with("SELECT container, identifier, interactionModel FROM fx_left WHERE container IS NOT NULL", "fx_left")
ORACLES["chunk_audit_stored"] = ORACLES["chunk_audit"]
ORACLES["binary_digest_stored"] = ORACLES["binary_digest"]
ORACLES["version_catalog_ids"] = f"""
        SELECT * FROM ({ORACLES["version_catalog"]}) WHERE identifier IN (SELECT 'data:/user/' || n_nationkey FROM nation)"""
ORACLES["nquads_split"] = f"""
        SELECT identifier, graph, subject, predicate, object, CAST(NULL AS VARCHAR) AS line FROM ({ORACLES["nquads_ingest"]})
        UNION ALL SELECT identifier, NULL, NULL, NULL, NULL, line FROM ({ORACLES["nquads_quarantine"]})"""
