"""Conversations repaired to alternating roles by the cheapest edits.

``repair`` edits the rows of each conversation, in the order of their turns, so
that the initials of roles read ``(s?(ua)+)?``. A row is kept (K, no cost, +3 if
its text is truncated), gets the role that fits (R, 3, +3 if truncated) or is
deleted (D, 4); an empty row of the role that fits is inserted anywhere (I, 3).
Blank rows and rows met before must be deleted. Of all cheapest edits the ones
whose letters sort first are taken.

Four states tell what may follow: nothing yet, after s, after u, after a. A
forward vector has for each state the least cost to reach it and, as a number,
the order of the letters that do so; a backward vector has the least cost to
the end. Both meet in the middle; of the crossings of least cost the one whose
letters sort first is part of the answer, and each half is solved in the same
way (Hirschberg's division), with no table over all rows. A vector less its
least cost takes few values, so its steps are remembered.

A conversation may hold a third of all rows. Rows are sorted by ranges and cut
into blocks of 4,096; a task reduces a block to the costs and orders between
its four first and last states. One pass over the blocks of a conversation
carries the forward vector, one the backward vector, which gives the crossing
at every border of blocks; then each block is solved by itself, anywhere. Only
a text's digest needs all of its rows in order: they stream through one task,
which holds a batch.

Defined cases: a null role or text is one space; a null conv_id is a
conversation, a null turn comes first; rows of one turn are in the order of
role and text (of its first 64 characters, then of its hash); repeated rows are
rows of their own, all but the first duplicates; extra columns are left out; an
empty table gives an empty one. ``conv_id`` may have any type that sorts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from quadloom.llm.common import checkpointed

BLOCK_BITS = 12  # rows of a block: 2 to this power
INSERT, DELETE, REROLE, TRUNCATED = 3, 4, 3, 3
WORD = r"[^\x20\x09-\x0D]"
_FIRST = ord("A")  # of the codes of rows: its fault times 4 and the class of its role
_FAULTS = ("", "blank", "duplicate", "truncated")
_CLASSES = "suax"
_LEGAL = {"su", "ua", "au"}
_NEXT = (2, 2, 3, 2)  # the state after the role that fits
_ROLE = ("", "", "user", "assistant")  # the role that leads to a state
_END = (0, 6, 3, 0)  # cost of the rows to insert after the last one
START = 0

# of each state: cost and order of the letters that lead to it, None where nothing does
Forward = tuple[tuple[int, int] | None, ...]
Backward = tuple[int | None, ...]


def _moves(state: int, code: int) -> Iterator[tuple[str, int, int]]:
    """What may be done with a row: its letter, the next state, the cost."""
    fault, role = divmod(code - _FIRST, 4)
    yield "D", state, DELETE
    if fault in (1, 2):
        return
    more = TRUNCATED if fault == 3 else 0
    yield "R", _NEXT[state], REROLE + more
    if (role == 0 and state == 0) or (role == 1 and state != 2) or (role == 2 and state == 2):
        yield "K", role + 1, more


def _edits(state: int, code: int) -> Iterator[tuple[str, int, int]]:
    """Letters that end with a row, after at most two insertions, as more would come back to a state."""
    for n in range(3):
        for letter, to, cost in _moves(state, code):
            yield "I" * n + letter, to, cost + n * INSERT
        state = _NEXT[state]


@cache
def _ahead(vector: Forward, code: int) -> tuple[int, Forward]:
    """The forward vector after one more row, less its least cost, and that cost."""
    best: dict[int, tuple[int, int, str]] = {}
    for state, entry in enumerate(vector):
        if entry is not None:
            for letters, to, cost in _edits(state, code):
                offer = (entry[0] + cost, entry[1], letters)
                if to not in best or offer < best[to]:
                    best[to] = offer
    # letters that end with a row are never the start of others, so they sort as their parts do
    order = sorted(best, key=lambda s: best[s][1:])
    least = min(b[0] for b in best.values())
    return least, tuple((best[s][0] - least, order.index(s)) if s in best else None for s in range(4))


@cache
def _back(code: int, vector: Backward) -> tuple[int, Backward]:
    """The backward vector before one more row, less its least cost, and that cost."""
    costs = [
        min((c + vector[to] for _, to, c in _edits(state, code) if vector[to] is not None), default=None)
        for state in range(4)
    ]
    least = min(c for c in costs if c is not None)
    return least, tuple(None if c is None else c - least for c in costs)


def only(state: int) -> Forward:
    return tuple((0, 0) if s == state else None for s in range(4))


def forward(codes: bytes, vector: Forward) -> tuple[int, Forward]:
    total = 0
    for code in codes:
        cost, vector = _ahead(vector, code)
        total += cost
    return total, vector


def backward(codes: bytes, vector: Backward) -> tuple[int, Backward]:
    total = 0
    for code in reversed(codes):
        cost, vector = _back(code, vector)
        total += cost
    return total, vector


def crossing(ahead: Forward, back: Iterable[int | None]) -> int:
    """The state of least cost whose letters sort first."""
    met = [(f[0] + b, f[1], s) for s, (f, b) in enumerate(zip(ahead, back, strict=True)) if f and b is not None]
    return min(met)[2]


def letters(codes: bytes, start: int, end: int) -> str:
    """The edits of rows between two states."""
    if not codes:
        return ""
    if len(codes) == 1:
        return min((cost, edit) for edit, to, cost in _edits(start, codes[0]) if to == end)[1]
    half = len(codes) // 2
    _, ahead = forward(codes[:half], only(start))
    _, back = backward(codes[half:], tuple(0 if s == end else None for s in range(4)))
    middle = crossing(ahead, back)
    return letters(codes[:half], start, middle) + letters(codes[half:], middle, end)


def between(codes: bytes) -> list[int]:
    """For each first and last state: least cost and order, -1 where there is no way."""
    found = []
    for start in range(4):
        total, vector = forward(codes, only(start))
        for entry in vector:
            found += [-1, -1] if entry is None else [total + entry[0], entry[1]]
    return found


def _joined(vector: Forward, block: list[int]) -> Forward:
    """The forward vector after a block; costs are whole."""
    best: dict[int, tuple[int, int, int]] = {}
    for start, entry in enumerate(vector):
        if entry is not None:
            for to in range(4):
                cost, order = block[8 * start + 2 * to : 8 * start + 2 * to + 2]
                offer = (entry[0] + cost, entry[1], order)
                if cost >= 0 and (to not in best or offer < best[to]):
                    best[to] = offer
    order = sorted(best, key=lambda s: best[s][1:])
    return tuple((best[s][0], order.index(s)) if s in best else None for s in range(4))


def _joined_back(block: list[int], vector: list[int | None]) -> list[int | None]:
    pairs = [[(block[8 * start + 2 * to], vector[to]) for to in range(4)] for start in range(4)]
    return [min((c + v for c, v in row if c >= 0 and v is not None), default=None) for row in pairs]


def _streamed(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: StructType) -> DataFrame:
    """``fn`` over the rows of each partition, a batch of them in memory."""
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(schema).types
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        held, size = [], 0
        for row in fn(rows):
            held.append(row)
            size += 100 + sum(len(x) for x in row if isinstance(x, str))
            if size > 4 << 20:
                columns = zip(*held, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
                held, size = [], 0
        if held:
            columns = zip(*held, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return df.mapInArrow(run, schema)


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` numbered in the order of conversations and turns: conv_id, at, block, role, text, written once."""
    plain = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        # repeated rows may go to several tasks
        F.monotonically_increasing_id().alias("copy"),
    )
    by = [F.col("conv_id"), F.col("turn"), F.col("role"), F.left("text", F.lit(64)), F.xxhash64("text"), F.col("copy")]
    sorted_ = plain.repartitionByRange(*by).sortWithinPartitions(*by)
    at = F.monotonically_increasing_id()
    numbered = sorted_.select("conv_id", at.alias("at"), "role", "text")
    return checkpointed(numbered.withColumn("block", F.shiftright("at", BLOCK_BITS)))


def coded(numbered: DataFrame) -> DataFrame:
    """The codes of each block's rows: conv_id, block, codes."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    blank = ~F.col("text").rlike(WORD)
    open_ended = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    same = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    narrow = numbered.select("conv_id", "at", "block", role.alias("role"), blank.alias("blank"), open_ended.alias("open"), same.alias("same"))
    # numbers are unique, so no key of this join is hot
    first = narrow.groupBy("conv_id", "same").agg(F.min("at").alias("first")).select("first")
    marked = narrow.join(first, F.col("at") == F.col("first"), "left")
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("open"), 3).otherwise(0)
    code = F.char(F.lit(_FIRST) + fault * 4 + F.col("role"))
    # a list has the rows of one block at most
    listed = F.array_sort(F.collect_list(F.struct("at", code.alias("code"))))
    codes = F.array_join(F.transform(listed, lambda x: x["code"]), "")
    return marked.groupBy("conv_id", "block").agg(codes.alias("codes"))


def _typed(df: DataFrame, rest: str) -> StructType:
    """``conv_id`` of the type it has, and further columns."""
    conv = StructField("conv_id", df.schema["conv_id"].dataType)
    return StructType([conv, *StructType.fromDDL(rest).fields])


def solved(blocks: DataFrame) -> DataFrame:
    """The edits of each block: conv_id, block, start, letters, counts of faults, illegal pairs, cost of all (last block)."""

    def reduce(rows):
        for conv, block, codes in rows:
            yield conv, block, codes, between(codes.encode())

    def ahead(rows):
        """The forward vector before each block and the illegal pairs with the row before it."""
        now, vector, last = object(), None, ""
        for conv, block, codes, ways in rows:
            if conv != now:
                now, vector, last = conv, only(START), ""
            before = vector
            vector = _joined(vector, ways)
            roles = last + "".join(_CLASSES[(ord(c) - _FIRST) & 3] for c in codes)
            last = roles[-1]
            illegal = sum(a + b not in _LEGAL for a, b in zip(roles, roles[1:], strict=False))
            flat = [x for entry in before for x in (entry or (-1, -1))]
            yield conv, block, codes, ways, flat, illegal

    def back(rows):
        """The states at both ends of each block, from the last one on."""
        now, vector, end = object(), None, None
        for conv, block, codes, ways, flat, illegal in rows:
            before = tuple((a, b) if a >= 0 else None for a, b in zip(flat[::2], flat[1::2], strict=True))
            cost = None
            if conv != now:
                now, vector = conv, list(_END)
                after = _joined(before, ways)
                end = crossing(after, vector)
                cost = after[end][0] + _END[end]
            vector = _joined_back(ways, vector)
            start = crossing(before, vector)
            yield conv, block, codes, start, end, illegal, cost
            end = start

    def solve(rows):
        for conv, block, codes, start, end, illegal, cost in rows:
            edits = letters(codes.encode(), start, end)
            if cost is not None:
                edits += "I" * (_END[end] // INSERT)
            faults = [(ord(c) - _FIRST) >> 2 for c in codes]
            yield conv, block, start, edits, *(faults.count(i) for i in (1, 2, 3)), illegal, cost

    rest = "block long, codes string, ways array<long>"
    reduced = _streamed(blocks.select("conv_id", "block", "codes"), reduce, _typed(blocks, rest))
    dealt = reduced.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    carried = _streamed(dealt, ahead, _typed(blocks, f"{rest}, before array<long>, illegal long"))
    turned = carried.sortWithinPartitions("conv_id", F.desc("block"))
    ends = _streamed(turned, back, _typed(blocks, "block long, codes string, start int, end int, illegal long, cost long"))
    counts = "blank long, duplicate long, truncated long, illegal long, cost long"
    spread = ends.repartition("conv_id", "block")
    return _streamed(spread, solve, _typed(blocks, f"block long, start int, letters string, {counts}"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _applied(numbered: DataFrame, edits: DataFrame) -> DataFrame:
    """Rows of conversations, each block behind its edits: conv_id, block, kind, at, role, text, counts."""
    kept = numbered.select("conv_id", "block", F.lit(1).alias("kind"), "at", "role", "text", F.lit(None).cast("array<long>").alias("counts"))
    counts = F.array("start", *_COUNTS).cast("array<long>")
    head = edits.select("conv_id", "block", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"), F.lit("").alias("role"), F.col("letters").alias("text"), counts.alias("counts"))
    both = head.unionByName(kept).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "block", "kind", "at").drop("block", "at")


class _Replay:
    """Edits of one block applied to its rows as they come."""

    def __init__(self, state: int, edits: str):
        self.state, self.edits, self.at = state, edits, 0

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            self.state = _NEXT[self.state]
            yield "I", _ROLE[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = "sua".index(role[0]) + 1
            yield edit, role, text
        elif edit == "R":
            self.state = _NEXT[self.state]
            yield edit, _ROLE[self.state], text

    def rest(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


def _replayed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Every row that a repaired conversation has, and each block's edits: conv_id, edit, role, text, counts."""
    replay, owner = None, None
    for conv, kind, role, text, counts in rows:
        if kind == 0:
            if replay:
                yield from ((owner, *row, None) for row in replay.rest())
            replay, owner = _Replay(counts[0], text), conv
            yield conv, "", "", text, counts[1:]
        else:
            yield from ((conv, *row, None) for row in replay.row(role, text))
    if replay:
        yield from ((owner, *row, None) for row in replay.rest())


def repair(rows: DataFrame) -> DataFrame:
    """The rows of repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text."""
    numbered = ordered(rows)

    def placed(found):
        now, place = object(), 0
        for conv, edit, role, text, counts in _replayed(found):
            if conv != now:
                now, place = conv, 0
            if counts is None:
                yield conv, place, edit, role, text
                place += 1

    applied = _applied(numbered, solved(coded(numbered)))
    return _streamed(applied, placed, _typed(rows, "place long, edit string, role string, text string"))


def audits(rows: DataFrame) -> DataFrame:
    """Of each conversation with rows: the counts of its faults, cost and letters of its edits, digest of the repaired rows."""
    numbered = ordered(rows)

    def digested(found):
        now, made = object(), None
        for conv, edit, role, text, counts in _replayed(found):
            if conv != now:
                if made:
                    yield now, *made[0], "".join(made[1]), made[2].hexdigest()
                now, made, between_ = conv, ([0] * 5, [], hashlib.sha256()), b""
            if counts is not None:
                made[1].append(text)
                made[0][:] = [a + (b or 0) for a, b in zip(made[0], counts, strict=True)]
            else:
                made[2].update(between_ + f"{role}:{text}".encode())
                between_ = b"\n"
        if made:
            yield now, *made[0], "".join(made[1]), made[2].hexdigest()

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    applied = _applied(numbered, solved(coded(numbered)))
    return _streamed(applied, digested, _typed(rows, f"{counts}, audit string, repaired_sha256 string"))


def gaps(rows: DataFrame) -> DataFrame:
    """conv_id and how many turns between its first and last are missing."""
    missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return rows.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).cast("long").alias("gaps"))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with faults made by a rule: some are lost, emptied, cut short, repeated or of another role."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    plain = rows.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    ).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times: Column = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    return plain.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times)
    ).drop("col")


def digests(rows: DataFrame) -> DataFrame:
    """``audits`` of the damaged ``rows``, with a row for every conversation, also one that lost all."""
    left = damaged(rows)
    found = rows.select("conv_id").distinct()
    for part in (gaps(left), audits(left)):
        renamed = part.withColumnRenamed("conv_id", "own")
        found = found.join(renamed, F.col("conv_id").eqNullSafe(F.col("own")), "left").drop("own")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("gaps", *_COUNTS)}
    empty = {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest()))}
    return found.select("conv_id", *(e.alias(c) for c, e in (zero | empty).items()))
