"""Binaries as fixed-size chunks, and as whole objects.

A chunks table has identifier, size (bytes of the whole binary), chunkSize,
chunkIndex and chunk. Results that join chunks together come in segments of a
bounded number of bytes, in order; a binary or range of no more than that is
one row. Nothing joins a large binary into one value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadloom.functions import keys
from quadloom.operators.keyed import distinct_keys, per_key, picked, rows_with_keys
from quadloom.operators.state import newest
from quadloom.session import written
from quadloom.vocab import DEFAULT_CHUNK_SIZE, DEFAULTS, Settings

SEGMENT_BYTES = 64 * 1024 * 1024
# Most chunks joined in one segment, however small they are.
_SEGMENT_CHUNKS = 65_536
# Chunks of one row of a range request, and bytes that objects are cut into for many requests.
_RANGE_RUN = 64
_OBJECT_PIECE = 1 << 20
_MOST = 2_147_483_647
# Positions listed at once when a range of positions becomes rows.
_RUN = 4_096
# Digests joined per node of a digest tree.
_FANOUT = 4_096


def chunk_sizes(binaries: DataFrame, default: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Add ``chunkSize`` and ``error`` from ``hints ARRAY<STRING>``.

    No hints: the default. One hint: its number, at least 1. Anything else is
    an error and leaves the size null.
    """
    hints, hint = F.col("hints"), F.get("hints", F.lit(0))
    number = F.when(hint.rlike(r"\A[+-]?[0-9]+\z"), hint.try_cast("int"))
    error = (
        F.when(hints.isNull(), F.lit(None))
        .when(F.size(hints) > 1, F.lit("too many chunk sizes"))
        .when(F.size(hints) == 0, F.lit("no chunk size"))
        .when(number.isNull(), F.lit("not a number"))
        .when(number < 1, F.lit("chunk size below 1"))
    )
    size = F.when(hints.isNull(), F.lit(default)).when(error.isNull(), number)
    return binaries.withColumn("error", error.cast("string")).withColumn("chunkSize", size.cast("int"))


def chunk(binaries: DataFrame) -> DataFrame:
    """Split (identifier, content, chunkSize) into chunks. No shuffle.

    The last chunk is never full: empty content is one empty chunk, and an
    exact multiple of the size ends in an empty one.
    """
    size = F.octet_length("content")
    last = F.floor(size / F.col("chunkSize")).cast("int")
    spread = binaries.select(
        "identifier",
        "content",
        "chunkSize",
        F.explode(F.sequence(F.lit(0), last)).alias("chunkIndex"),
    )
    start = F.col("chunkIndex") * F.col("chunkSize") + 1
    return spread.select(
        "identifier",
        size.cast("bigint").alias("size"),
        "chunkSize",
        "chunkIndex",
        F.col("content").substr(start, F.col("chunkSize")).alias("chunk"),
    )


def _writable() -> Column:
    return F.col("identifier").isNotNull() & F.col("content").isNotNull() & (F.col("chunkSize") >= 1)


def with_digests(chunks: DataFrame) -> DataFrame:
    """Chunks with ``bytes`` and ``md5`` of each, made once when they are written.

    ``audit``, ``missing_chunks`` and ``digest`` use these columns where there
    are any, and then read no content.
    """
    size = F.octet_length("chunk").cast("int")
    return chunks.withColumn("bytes", size).withColumn("md5", F.md5("chunk"))


def _bytes(chunks: DataFrame) -> Column:
    return F.col("bytes") if "bytes" in chunks.columns else F.octet_length("chunk")


def set_content(chunks: DataFrame, binaries: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Replace all chunks of the binaries given, old tails included.

    A binary without content or a usable chunk size replaces nothing: what is
    there stays, and ``unset_content`` has it. Of several with one identifier
    the newest by the columns ``order`` is written; of those alike in it, or
    without ``order``, the one whose content and size have the least hash.
    """
    usable = binaries.filter(F.coalesce(_writable(), F.lit(False)))
    last = newest(usable.select("identifier", "content", "chunkSize", *order), ["identifier"], order)
    return purge(chunks, usable).unionByName(chunk(last))


def unset_content(binaries: DataFrame) -> DataFrame:
    """(identifier, reason) of the binaries that ``set_content`` does not write."""
    reason = (
        F.when(F.col("identifier").isNull(), "no identifier")
        .when(F.col("content").isNull(), "no content")
        .when(F.col("chunkSize").isNull() | (F.col("chunkSize") < 1), "no usable chunk size")
    )
    return binaries.select("identifier", reason.alias("reason")).filter(F.col("reason").isNotNull())


def purge(chunks: DataFrame, ids: DataFrame) -> DataFrame:
    """Remove all chunks (or the object) of each identifier."""
    return rows_with_keys(chunks, ids, "left_anti")


def layout(chunks: DataFrame) -> DataFrame:
    """Per binary: chunkSize, that of its first chunk, and lastIndex. Reads no payload."""
    return per_key(
        chunks,
        ["identifier"],
        chunkSize=F.min_by("chunkSize", "chunkIndex"),
        lastIndex=F.max("chunkIndex"),
    )


def lookup_chunk_sizes(ids: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunk size of each binary asked for; ``error`` names one that is missing."""
    joined = ids.select("identifier").join(layout(chunks).drop("lastIndex"), "identifier", "left")
    missing = F.concat(F.lit("missing binary "), F.col("identifier"))
    bad = F.concat(F.lit("chunk size below 1 for "), F.col("identifier"))
    error = F.when(F.col("chunkSize").isNull(), missing).when(F.col("chunkSize") < 1, bad)
    return joined.withColumn("error", error)


def _per_segment(segment_bytes: int) -> Column:
    """How many chunks make a segment."""
    fit = F.floor(F.lit(segment_bytes) / F.col("chunkSize"))
    return F.greatest(F.least(fit, F.lit(_SEGMENT_CHUNKS)), F.lit(1)).cast("int")


def _segments(pieces: DataFrame, by: list[str]) -> DataFrame:
    """Join pieces (by, segment, chunkIndex, piece) in order of index, per segment.

    The grouping key is one struct so that no partitioning by part of it, left
    behind by a join, puts all segments of a large binary in one task.
    """
    joined = F.expr("listagg(piece, X'') WITHIN GROUP (ORDER BY chunkIndex)")
    grouped = pieces.groupBy(F.struct(*by, "segment").alias("k")).agg(joined.alias("content"))
    return grouped.select("k.*", "content")


def read_all(chunks: DataFrame, ids: DataFrame | None = None, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Content of binaries as (identifier, segment, content).

    With ``ids`` given, each of them is answered once, with ``found``.
    """
    pieces = chunks
    if ids is not None:
        ids = distinct_keys(ids)
        pieces = rows_with_keys(chunks, ids)
    # The empty chunk that ends an exact multiple must not start a segment.
    pieces = pieces.filter((F.col("chunkIndex") == 0) | (F.octet_length("chunk") > 0))
    segment = F.floor(F.col("chunkIndex") / _per_segment(segment_bytes)).cast("int")
    pieces = pieces.select("identifier", segment.alias("segment"), "chunkIndex", F.col("chunk").alias("piece"))
    whole = _segments(pieces, ["identifier"])
    if ids is None:
        return whole
    # Segments are not joined to ids: all of a large binary would meet in a task.
    absent = ids.join(chunks.select("identifier").distinct(), "identifier", "left_anti")
    absent = absent.select(
        "identifier",
        F.lit(None).cast("int").alias("segment"),
        F.lit(None).cast("binary").alias("content"),
        F.lit(False).alias("found"),
    )
    return whole.withColumn("found", F.lit(True)).unionByName(absent)


def _positions(df: DataFrame, first: str, last: str, name: str) -> DataFrame:
    """A row for each position from ``first`` to ``last``, none when last < first.

    Listed in two steps, so that no array grows with the range.
    """
    runs = F.when(F.col(first) <= F.col(last), F.sequence(F.col(first), F.col(last), F.lit(_RUN)))
    stepped = df.select("*", F.explode(runs).alias("_from"))
    end = F.least(F.col("_from") + (_RUN - 1), F.col(last))
    return stepped.select("*", F.explode(F.sequence(F.col("_from"), end)).alias(name)).drop("_from")


def read_range(chunks: DataFrame, ranges: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Bytes ``from`` to ``to``, both included, for each request.

    ``ranges`` has req (unique), identifier, from and to. The answer is
    (req, identifier, segment, content, found): short past the end, empty when
    it starts past the end, null for a binary that is not there.

    Requests are clamped to the chunks there are, and are written once, a row
    for each run of ``_RANGE_RUN`` chunks that they touch. Up to
    ``BROADCAST_BYTES`` of them go to the chunks, which are cut where they lie:
    only the bytes asked for move. More meet them by (identifier, run), which
    spreads a large or popular binary over all tasks; a filter keeps chunks of
    other runs from moving. Segments begin at chunk edges, counted from the
    first chunk touched.
    """
    placed = ranges.join(layout(chunks), "identifier", "left")
    c = F.col("chunkSize").cast("bigint")
    placed = placed.select(
        "req",
        "identifier",
        "from",
        "to",
        "chunkSize",
        F.col("chunkSize").isNotNull().alias("found"),
        F.floor(F.col("from") / c).alias("_first"),
        F.least(F.floor(F.col("to") / c), F.col("lastIndex").cast("bigint")).alias("_last"),
    )
    placed = written(placed, "ranges")
    runs = placed.withColumn("_a", F.floor(F.col("_first") / _RANGE_RUN)).withColumn("_b", F.floor(F.col("_last") / _RANGE_RUN))
    asked = picked(_positions(runs.filter("_first <= _last"), "_a", "_b", "_run").drop("_a", "_b"), "runs")
    by = ["identifier", "_run"]
    held = chunks.select("identifier", "chunkIndex", "chunk", F.floor(F.col("chunkIndex") / _RANGE_RUN).alias("_run"))
    met = asked.pruned(held, by).join(asked.hinted(), by).filter(F.col("chunkIndex").between(F.col("_first"), F.col("_last")))
    base = F.col("chunkIndex").cast("bigint") * F.col("chunkSize")
    skip = F.greatest(F.col("from") - base, F.lit(0))
    take = F.least(F.col("to") - base, F.col("chunkSize").cast("bigint") - 1) - skip + 1
    segment = F.floor((F.col("chunkIndex") - F.col("_first")) / _per_segment(segment_bytes))
    pieces = met.filter(F.octet_length("chunk") > skip).select(
        "req",
        "identifier",
        "found",
        segment.cast("int").alias("segment"),
        "chunkIndex",
        F.col("chunk").substr((skip + 1).cast("int"), take.cast("int")).alias("piece"),
    )
    # Every request has a piece of no chunk, so that one without any is answered too.
    nothing = placed.select(
        "req", "identifier", "found", F.lit(0).alias("segment"), F.lit(-1).alias("chunkIndex"), F.when(F.col("found"), F.lit(b"")).alias("piece")
    )
    segments = _segments(pieces.unionByName(nothing), ["req", "identifier", "found"])
    return segments.select("req", "identifier", "segment", "content", "found")


def read_range_object(objects: DataFrame, ranges: DataFrame) -> DataFrame:
    """The same on unchunked (identifier, content): (req, identifier, content, found).

    Up to ``BROADCAST_BYTES`` of requests go to the objects. More are answered
    from objects cut into pieces of ``_OBJECT_PIECE`` bytes, as a table of
    chunks is, so that no more of a popular or large object moves than is asked for.
    """
    asked = picked(ranges.select("req", "identifier", "from", "to"), "ranges")
    if not asked.small:
        pieces = chunk(objects.select("identifier", "content", F.lit(_OBJECT_PIECE).alias("chunkSize")))
        return read_range(pieces, asked.rows, _MOST).drop("segment")
    start, count = (F.least(x, F.lit(_MOST)).cast("int") for x in (F.col("from") + 1, F.col("to") - F.col("from") + 1))
    past = F.col("from") >= F.octet_length("content")
    content = F.when(past, F.lit(b"")).otherwise(F.col("content").substr(start, count))
    met = objects.select("identifier", "content").join(F.broadcast(asked.rows), "identifier")
    answers = met.select("req", "identifier", content.alias("content"), F.lit(True).alias("found"))
    absent = asked.rows.join(rows_with_keys(objects.select("identifier"), asked.rows), "identifier", "left_anti")
    return answers.unionByName(absent.select("req", "identifier", F.lit(None).cast("binary").alias("content"), F.lit(False).alias("found")))


def audit(chunks: DataFrame) -> DataFrame:
    """Integrity of each binary from its chunk rows, in counts.

    The write that put chunk 0 there is the current one. ``missing`` counts
    its indexes without a row, the last one included; ``wrong_size`` its rows
    of another length than they should have; ``stale`` rows past its end or
    left over from another write.
    """
    return _current_writes(chunks).select(
        "identifier",
        "chunks",
        (F.col("w.last") + 1 - F.col("w.inside")).alias("missing"),
        F.col("w.wrong").alias("wrong_size"),
        (F.col("chunks") - F.col("w.inside")).alias("stale"),
    )


def _current_writes(chunks: DataFrame) -> DataFrame:
    """Per binary: how many chunks there are, and ``w``, counts of its current write."""
    end = F.floor(F.col("size") / F.col("chunkSize"))
    rest = F.col("size") - end * F.col("chunkSize")
    due = F.when(F.col("chunkIndex") < end, F.col("chunkSize")).otherwise(rest)
    inside = F.col("chunkIndex") <= end
    writes = (
        chunks.select(
            "identifier",
            "size",
            "chunkSize",
            "chunkIndex",
            end.alias("last"),
            inside.alias("inside"),
            (inside & (_bytes(chunks) != due)).alias("wrong"),
        )
        .groupBy("identifier", "size", "chunkSize", "last")
        .agg(
            F.count("*").alias("rows"),
            F.count_if("inside").alias("inside"),
            F.count_if("wrong").alias("wrong"),
            F.max((F.col("chunkIndex") == 0).cast("int")).alias("first"),
        )
    )
    current = F.max(F.struct("first", "inside", "last", "wrong", "size", "chunkSize")).alias("w")
    return writes.groupBy("identifier").agg(F.sum("rows").alias("chunks"), current)


def missing_chunks(chunks: DataFrame) -> DataFrame:
    """(identifier, chunkIndex) of every gap in the current write of a binary, its last chunk included.

    A chunk that another write left at an index does not fill it.
    """
    spans = _current_writes(chunks).select(
        "identifier",
        "w.size",
        "w.chunkSize",
        F.lit(0).cast("bigint").alias("first"),
        F.col("w.last").cast("bigint").alias("last"),
    )
    by = ["identifier", "size", "chunkSize", "chunkIndex"]
    due = _positions(spans, "first", "last", "position").withColumn("chunkIndex", F.col("position").cast("int"))
    return due.select(*by).join(chunks.select(*by), by, "left_anti").select("identifier", "chunkIndex")


def object_digest(objects: DataFrame) -> DataFrame:
    """(identifier, bytes, md5) of whole objects, whose content is one value. No shuffle."""
    size = F.octet_length("content").cast("bigint")
    return objects.select("identifier", size.alias("bytes"), F.md5("content").alias("md5"))


def digest(chunks: DataFrame) -> DataFrame:
    """Digest per binary of any size: (identifier, bytes, tree_md5).

    Hex digests of the chunks, in groups of 4,096 in order, are joined and
    digested, and that result twice more likewise. No binary is joined whole;
    ``object_digest`` has the plain md5 of content that is one value.
    """
    leaves = chunks.select(
        "identifier",
        F.col("chunkIndex").cast("bigint").alias("position"),
        _bytes(chunks).cast("bigint").alias("bytes"),
        (F.col("md5") if "md5" in chunks.columns else F.md5("chunk")).alias("digest"),
    )
    # An index is an INT: three levels of 4,096 cover all there can be.
    for _ in range(3):
        leaves = _digest_level(leaves)
    return leaves.select("identifier", "bytes", F.col("digest").alias("tree_md5"))


def _digest_level(nodes: DataFrame) -> DataFrame:
    parent = F.floor(F.col("position") / _FANOUT)
    joined = F.expr("listagg(digest, '') WITHIN GROUP (ORDER BY position)")
    return (
        nodes.groupBy(F.struct("identifier", parent.alias("position")).alias("k"))
        .agg(F.sum("bytes").alias("bytes"), F.md5(joined.cast("binary")).alias("digest"))
        .select("k.identifier", "k.position", "bytes", "digest")
    )


def put_objects(binaries: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Objects (key, content, mimeType) to append; ids of another scheme are left out."""
    keyed = binaries.withColumn("key", keys.binary_key("identifier", settings))
    return keyed.filter(F.col("key").isNotNull()).select("key", "content", "mimeType")
