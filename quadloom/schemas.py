"""Table schemas, as DDL text usable with ``spark.read.schema``."""

RESOURCES = (
    "identifier STRING, interactionModel STRING, container STRING, binaryIdentifier STRING, "
    "mimeType STRING, modified TIMESTAMP_NTZ, created TIMESTAMP_NTZ, seq BIGINT, quads STRING"
)
MEMBERSHIP = (
    "membershipResource STRING, memberRelation STRING, memberOfRelation STRING, "
    "insertedContentRelation STRING"
)
VERSIONS = f"{RESOURCES}, mementomodified TIMESTAMP_NTZ, {MEMBERSHIP}"
IMMUTABLE = "identifier STRING, created TIMESTAMP_NTZ, quads STRING"
QUADS = "identifier STRING, graph STRING, subject STRING, predicate STRING, object STRING"
CHUNKS = "identifier STRING, size BIGINT, chunkSize INT, chunkIndex INT, chunk BINARY"
OBJECTS = "key STRING, meta MAP<STRING,STRING>, body STRING"
BINARY_OBJECTS = "key STRING, content BINARY, mimeType STRING"
REQUESTS = "req BIGINT, identifier STRING, at TIMESTAMP_NTZ"
RANGES = "req BIGINT, identifier STRING, `from` BIGINT, `to` BIGINT"
OPS = "op STRING, identifier STRING, ts TIMESTAMP_NTZ, seq BIGINT"
NOTIFICATIONS = (
    "id STRING, object STRING, agents ARRAY<STRING>, types ARRAY<STRING>, "
    "objectTypes ARRAY<STRING>, created TIMESTAMP_NTZ"
)

QUAD_COLUMNS = ("identifier", "graph", "subject", "predicate", "object")
MEMBERSHIP_COLUMNS = (
    "membershipResource",
    "memberRelation",
    "memberOfRelation",
    "insertedContentRelation",
)
