"""Token ids in files of directly addressable codes.

An id is split into bytes. Level 0 has the lowest byte of every id, level 1 the
next byte of those ids that have one, and so on; a bitmap of each level tells
which of its ids go on, and a directory of counts per 512 bits gives their rank
and so their place in the next level. Any token is found by its number with a
few look-ups, and nothing around it is decoded.

``write`` encodes texts in ascending order of document and writes segments:
rows of Parquet files, each with its documents, where their ids end, and the
codes. A segment holds whole documents and closes after about half a million
ids. Tasks write by Spark's commit protocol, so a lost executor repeats its
part alone. ``read`` gives every document its ids again, and where they start
in the order of all ids.

Defined cases: a null text is an empty one and has the end id alone; a null
doc_id comes first; rows of equal doc_id come in the order of a hash of their
texts and are documents of their own; extra columns are left out; an empty
table gives no segment.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadloom.llm.byte_ids import load
from quadloom.llm.common import slices
from quadloom.session import work_folder

SEGMENT_IDS = 1 << 19
_BLOCK = 512  # bits per entry of a rank directory
SEGMENTS = "part int, segment int, first long, n_tokens long, doc_ids array<bigint>, ends array<bigint>, codes binary"


def pack(ids: np.ndarray) -> bytes:
    """Unsigned 32-bit ids as levels, bitmaps and directories."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while True:
        low = (rest & 255).astype(np.uint8)
        goes_on = rest > 255
        rest = rest[goes_on] >> 8
        if not len(rest):
            levels.append((low, b"", b""))
            break
        bits = np.packbits(goes_on, bitorder="little")
        starts = np.arange(0, len(goes_on), _BLOCK)
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(goes_on, starts, dtype=np.uint32))[:-1]])
        levels.append((low, bits.tobytes(), ranks.astype("<u4").tobytes()))
    head = struct.pack("<4sI", b"DAC1", len(levels)) + b"".join(struct.pack("<Q", len(low)) for low, _, _ in levels)
    return head + b"".join(part for low, bits, ranks in levels for part in (low.tobytes(), bits, ranks))


def _levels(codes: bytes) -> list[tuple[int, int, int, int]]:
    """Of each level: number of ids, and where its bytes, bitmap and directory start."""
    mark, n = struct.unpack_from("<4sI", codes)
    if mark != b"DAC1":
        raise ValueError("not a segment of codes")
    sizes = struct.unpack_from(f"<{n}Q", codes, 8)
    at, found = 8 + 8 * n, []
    for i, size in enumerate(sizes):
        bits = at + size
        ranks = bits + (-(-size // 8) if i + 1 < n else 0)
        found.append((size, at, bits, ranks))
        at = ranks + (4 * -(-size // _BLOCK) if i + 1 < n else 0)
    return found


def unpack(codes: bytes) -> np.ndarray:
    """All ids of a segment."""
    levels = _levels(codes)
    ids = np.zeros(levels[0][0], np.uint32)
    at = np.arange(len(ids))
    for k, (size, low, bits, _) in enumerate(levels):
        ids[at] |= np.frombuffer(codes, np.uint8, size, low).astype(np.uint32) << np.uint32(8 * k)
        if k + 1 < len(levels):
            more = np.unpackbits(np.frombuffer(codes, np.uint8, -(-size // 8), bits), count=size, bitorder="little")
            at = at[more.view(bool)]
    return ids


def token_at(codes: bytes, i: int) -> int:
    """Id number ``i`` of a segment, by ranks alone."""
    found, levels = 0, _levels(codes)
    if not 0 <= i < levels[0][0]:
        raise IndexError(i)
    for k, (_, low, bits, ranks) in enumerate(levels):
        found |= codes[low + i] << (8 * k)
        if k + 1 == len(levels) or not codes[bits + (i >> 3)] >> (i & 7) & 1:
            break
        block = i // _BLOCK
        start = bits + block * (_BLOCK // 8)
        ahead = int.from_bytes(codes[start : bits + (i >> 3) + 1], "little")
        ahead &= (1 << (i - block * _BLOCK)) - 1
        i = struct.unpack_from("<I", codes, ranks + 4 * block)[0] + ahead.bit_count()
    return found


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Write the ids of ``docs`` (doc_id, text), each document closed by ``end_id``, as segments below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = load(vocabulary), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        segment = first = held = 0
        doc_ids: list[pa.Array] = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            n, owners = np.concatenate(sizes), pa.concat_arrays(doc_ids)
            ends = np.cumsum(n)
            at = pa.array([0, len(n)], pa.int32())
            row = [
                pa.array([part], pa.int32()),
                pa.array([segment], pa.int32()),
                pa.array([first], pa.int64()),
                pa.array([int(ends[-1])], pa.int64()),
                pa.ListArray.from_arrays(at, owners),
                pa.ListArray.from_arrays(at, pa.array(ends)),
                pa.array([pack(np.concatenate(ids))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(row, names=[f.split()[0] for f in SEGMENTS.split(", ")])

        for batch in batches:
            for cut in slices(batch, "text"):
                coded = [encode(text.as_py() or "") for text in cut.column("text")]
                ids.append(np.concatenate([x for own in coded for x in (own, end)]))
                sizes.append(np.fromiter(map(len, coded), np.int64, len(coded)) + 1)
                doc_ids.append(cut.column("doc_id"))
                held += len(ids[-1])
                if held >= SEGMENT_IDS:
                    yield close()
                    segment, first, held = segment + 1, first + held, 0
                    doc_ids, ids, sizes = [], [], []
        if held:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    ordered.mapInArrow(run, SEGMENTS).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (binary, little-endian 32 bits) of every document below ``path``."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    # one row per task that wrote
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    base = parts.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, _, first, _, doc_ids, ends, codes = (batch.column(i)[row] for i in range(7))
                raw = unpack(codes.as_py()).astype("<u4").tobytes()
                ends = ends.values.to_numpy()
                starts = np.concatenate([[0], ends[:-1]])
                ids = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                own = [
                    pa.array(np.full(len(ends), part.as_py(), np.int32)),
                    doc_ids.values,
                    pa.array(starts + first.as_py()),
                    pa.array(ends - starts),
                    pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(own, names=["part", "doc_id", "first", "n_tokens", "ids"])

    found = segments.mapInArrow(run, "part int, doc_id long, first long, n_tokens long, ids binary")
    return found.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids"
    )


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """What the files of ``docs`` hold: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = work_folder(spark, "codes")
    write(docs, path, vocabulary, end_id)
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
