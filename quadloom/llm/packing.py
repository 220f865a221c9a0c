"""Token sequences of one length from whole documents, with little padding.

``pack`` gives the pieces of documents and the sequence that each lies in. The
method is bounded-space online packing: a task keeps a fixed number of open
windows. Of a document, full windows go out at once; what is left of it goes
whole into the open window in which it fits best. Where it fits in none and all
windows are open, its head fills up the fullest one, which goes out, and the
rest opens a new window. Windows that are still open when a task ends are
merged by the same packing over ``_FAN`` tasks at a time, until one group is
left, whose last windows are poured together. The rest of fewer ids than a
window is cut into sequences of a power of two, which need no padding.

A task holds the open windows alone. Texts are never shuffled: leftovers, at
most ``open_windows`` windows a task, are all that moves.

Defined cases: a null or empty text is one document of the end id alone; rows
of equal or null doc_id are documents of their own; extra columns are left out;
an empty table gives no pieces. ``sequence_id`` is unique and ascends in the
order of tasks; it isn't consecutive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.llm.byte_ids import load
from quadloom.llm.common import checkpointed, slices

_FAN = 32
_FLUSH = 4 << 20  # bytes of ids per batch that leaves a task
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"
_STEP = f"{PIECES}, task long, open boolean"


@dataclass
class Piece:
    """Ids of a document from ``start`` on, as bytes."""

    doc_id: int | None
    start: int
    doc_tokens: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.doc_tokens, self.ids[: 4 * n])
        return head, Piece(self.doc_id, self.start + n, self.doc_tokens, self.ids[4 * n :])


@dataclass
class Window:
    room: int
    pieces: list[Piece] = field(default_factory=list)

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.room -= len(piece)


class Packer:
    """Open windows; ``emit`` is called with the pieces of each sequence that is done."""

    def __init__(self, length: int, open_windows: int, emit: Callable[[list[Piece]], None]):
        self.length, self.most, self.emit = length, open_windows, emit
        self.open: list[Window] = []

    def add(self, piece: Piece) -> None:
        while len(piece) >= self.length:
            head, piece = piece.cut(self.length)
            self.emit([head])
        if not len(piece):
            return
        # the least room that is enough; the oldest of equals
        best = min((w for w in self.open if w.room >= len(piece)), key=lambda w: w.room, default=None)
        if best is None and len(self.open) == self.most:
            best = min(self.open, key=lambda w: w.room)
            head, piece = piece.cut(best.room)
            self._into(best, head)
            best = None
        if best is None:
            best = Window(self.length)
            self.open.append(best)
        self._into(best, piece)

    def _into(self, window: Window, piece: Piece) -> None:
        window.add(piece)
        if not window.room:
            self.open.remove(window)
            self.emit(window.pieces)

    def finish(self) -> None:
        """Pour the open windows together: full ones, then a rest by powers of two."""
        rest = [p for w in sorted(self.open, key=lambda w: w.room) for p in w.pieces]
        self.open = []
        left = sum(map(len, rest))
        while left:
            size = min(self.length, 1 << (left.bit_length() - 1))
            window = Window(size)
            while window.room:
                head, tail = rest[0].cut(min(window.room, len(rest[0])))
                window.add(head)
                rest[:1] = [tail] if len(tail) else []
            self.emit(window.pieces)
            left -= size


class _Rows:
    """Rows of pieces on their way out of a task."""

    def __init__(self, first: int):
        self.rows: list[tuple] = []
        self.held, self.first, self.closed = 0, first, 0

    def take(self, pieces: list[Piece], task: int, open_: bool = False) -> None:
        offset = 0
        for p in pieces:
            number = (self.first + task) << 32 | self.closed
            self.rows.append((p.doc_id, p.start, len(p), p.doc_tokens, p.ids, number, offset, task, open_))
            offset += len(p)
            self.held += len(p.ids)
        self.closed += 1

    def out(self) -> pa.RecordBatch:
        types = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 3 + [pa.bool_()]
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(types)
        self.rows, self.held = [], 0
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _STEP.split(", ")])


def _first_step(docs: DataFrame, vocabulary: str, end_id: int, length: int, open_windows: int) -> DataFrame:
    end = np.uint32(end_id).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task, rows = load(vocabulary), TaskContext.get().partitionId(), _Rows(0)
        packer = Packer(length, open_windows, lambda pieces: rows.take(pieces, task))
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                    coded = ids(text.as_py() or "").astype("<u4").tobytes() + end
                    packer.add(Piece(doc_id, 0, len(coded) // 4, coded))
                    if rows.held >= _FLUSH:
                        yield rows.out()
        for window in packer.open:
            rows.take(window.pieces, task, True)
        yield rows.out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _STEP)


def _merge(left: DataFrame, first: int, length: int, open_windows: int, last: bool) -> DataFrame:
    """Leftovers of ``_FAN`` tasks packed together; the number of the first task is ``first``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, group, packer = _Rows(first), None, None

        def close() -> None:
            if packer and last:
                packer.finish()
            elif packer:
                for window in packer.open:
                    rows.take(window.pieces, group, True)

        for batch in batches:
            for doc_id, start, doc_tokens, ids, owner in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if owner != group:
                    close()
                    group, rows.closed = owner, 0
                    packer = Packer(length, open_windows, lambda pieces: rows.take(pieces, group))
                packer.add(Piece(doc_id, start, doc_tokens, ids))
                if rows.held >= _FLUSH:
                    yield rows.out()
        close()
        yield rows.out()

    own = left.withColumn("owner", F.expr(f"task div {_FAN}"))
    own = own.repartition("owner").sortWithinPartitions("owner", "sequence_id", "offset")
    return own.select("doc_id", "start", "doc_tokens", "ids", "owner").mapInArrow(run, _STEP)


def pack(
    docs: DataFrame, vocabulary: str, end_id: int = 0, length: int = 1024, open_windows: int = 16
) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text), each document closed by ``end_id``, in sequences of at most ``length`` ids.

    ``ids`` are the piece's ids as little-endian 32-bit integers, ``start`` the
    document's ids before it, ``offset`` the sequence's ids before it.
    """
    if length < 1 or open_windows < 1:
        raise ValueError("a sequence has one id and a task one window at least")
    step = checkpointed(_first_step(docs, vocabulary, end_id, length, open_windows))
    names = [c.split()[0] for c in PIECES.split(", ")]
    done = step.where("not open").select(names)
    tasks = (step.agg(F.max("task")).first()[0] or 0) + 1
    first, last = tasks, False
    while not last:
        groups = -(-tasks // _FAN)
        last = groups == 1
        step = checkpointed(_merge(step.where("open"), first, length, open_windows, last))
        done = done.unionByName(step.where("not open").select(names))
        first, tasks = first + groups, groups
    return done


def digests(docs: DataFrame, vocabulary: str, end_id: int = 0, length: int = 1024) -> DataFrame:
    """The pieces of ``docs`` with a checksum of their ids."""
    return pack(docs, vocabulary, end_id, length).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
