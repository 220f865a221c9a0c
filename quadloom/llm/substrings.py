"""Exact removal of long substrings that occur earlier, over all documents.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier:
in a document before, or in the same one further left. Documents are in the
order of doc_id; matches never cross documents; strings are judged on the input.

A suffix array over all bytes would not fit, so suffixes are sorted in groups.
Every window of ``LENGTH`` bytes is assigned to the position in it whose 40-byte
string has the least hash (the leftmost of equals). Equal windows have equal
such strings, so they meet in one group, and windows next to each other mostly
share one: about one position in thirty stands for all of them. Three steps:

1. Positions of all texts, with the windows each stands for, are grouped by
   hash, sorted by Spark; groups of one are dropped.
2. Of the rest, the bytes around each position are fetched and grouped again.
   Equal surroundings are merged as they stream by. The windows of the others
   are suffixes that a hash-compared mergesort orders (``suffixes.order``);
   equal neighbours are verified by their bytes, and all but the earliest of
   each class are repeats.
3. Repeats become spans, and spans meet their texts.

Whole copies of a text are found first, by a digest, and need none of this.

Memory of a task: a slice of texts, or the distinct surroundings (at most 160
bytes each) of one 40-byte string of at most ``HOT`` positions (beyond 20 GB of text,
a millionth of its bytes). Of strings with more, each window is a surrounding of its own, dealt by a hash of its bytes. Shuffled are the texts, once, since the
three uses share one exchange, and some 30 bytes per position.

Defined cases: a null text is empty; a null doc_id comes before all others;
texts of one doc_id are in the order of a hash of them, and equal ones are one
document, of which each row has the result; extra columns don't matter; texts
shorter than ``LENGTH`` bytes stay whole; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from quadloom.llm.common import Batches, in_arrow, slices
from quadloom.llm.suffixes import Hashes, order

LENGTH = 100
ANCHOR = 40
_SPREAD = LENGTH - ANCHOR + 1  # positions of an anchor in a window
_CHUNK = 1 << 20  # windows that are taken up at a time
# In the low byte of a place, above the number of further windows: the key is known to be repeated; and a copy of
# such a row that only stands for its key.
_KNOWN, _STANDS = 64, 128
_INDEX = np.uint64((1 << 24) - 1)
_WINDOWS = 400_000  # windows that are sorted at a time
_ROWS = 4000  # surroundings after which sorting starts at the next group
HOT = 20_000  # positions of a key above which its windows are dealt one by one, or more of them:
_MOST_HOT = 1_000_000  # so many keys that at most so many are hot, 8 bytes each to all executors
_PIECE = 200_000  # windows whose bytes are taken up at a time


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts without nulls, and where each text starts."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(29))


def anchors(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Key, text number, position, and first and last window, of each anchor; places are within the text."""
    for at in range(0, max(0, len(raw) - LENGTH + 1), _CHUNK):
        part = raw[at : at + _CHUNK + LENGTH - 1]
        hashes = Hashes(part)
        keys = _mixed(hashes.of(np.arange(len(part) - ANCHOR + 1), ANCHOR))
        # the high bits of the hash, then the place, so that the leftmost of equals is least
        value = (keys & ~_INDEX) | np.arange(len(keys), dtype=np.uint64)
        n = len(value)
        padded = np.full(-(-n // _SPREAD) * _SPREAD, np.iinfo(np.uint64).max)
        padded[:n] = value
        rows = padded.reshape(-1, _SPREAD)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[: n - _SPREAD + 1], ahead[_SPREAD - 1 : n])
        place = (least & _INDEX).astype(np.int64)
        start = np.arange(len(place))
        text = np.searchsorted(offsets, start + at, "right") - 1
        inside = np.flatnonzero(start + at + LENGTH <= offsets[text + 1])
        if not len(inside):
            continue
        place, text = place[inside], text[inside]
        new = np.flatnonzero((place[1:] != place[:-1]) | (np.diff(inside) > 1) | (text[1:] != text[:-1])) + 1
        first = np.concatenate([[0], new])
        last = np.concatenate([new - 1, [len(inside) - 1]])
        shift = at - offsets[text[first]]
        yield keys[place[first]].view(np.int64), text[first], place[first] + shift, inside[first] + shift, inside[last] + shift


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, d, o and place (first window, offset of the anchor, further windows) of each anchor of d, o, text.

    Rows whose key a slice has more than once are marked as known, and one
    marked copy stands for them among the keys of other slices, so a hot key
    is a row for each slice there.
    """
    names = ["key", "d", "o", "place"]
    for batch in batches:
        for part in slices(batch, "text"):
            raw, offsets = _bytes(part.column("text"))
            found = list(anchors(raw, offsets))
            if not found:
                continue
            key, text, at, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
            place = (first << 16) | ((at - first) << 8) | (last - first)
            by = np.argsort(key, kind="stable")
            same = key[by[1:]] == key[by[:-1]]
            again = np.concatenate([[False], same])
            several = again | np.concatenate([same, [False]])
            place[by[several]] |= _KNOWN
            stand = by[several & ~again]
            key = np.concatenate([key, key[stand]])
            place = np.concatenate([place, (place[stand] & ~_KNOWN) | _STANDS])
            owner = pa.array(np.concatenate([text, text[stand]]))
            columns = [pa.array(key), part.column("d").take(owner), part.column("o").take(owner), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those whose key is not alone or known to be repeated, without marks."""
    last_key, held = None, None  # held: the last row, if it is the first of its key
    for batch in batches:
        place = batch.column("place").to_numpy()
        known = (place & _KNOWN) > 0
        if known.any():
            plain = batch.set_column(3, "place", pa.array(place & ~_KNOWN))
            yield plain.filter(pa.array(known))
            batch = batch.filter(pa.array(~known))
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        as_before = np.concatenate([[last_key is not None and key[0] == last_key], key[1:] == key[:-1]])
        keep = as_before | np.concatenate([as_before[1:], [False]])
        if held is not None and as_before[0]:
            yield held
        own = (batch.column("place").to_numpy() & _STANDS) == 0
        yield batch.filter(pa.array(keep & own))
        held = None if keep[-1] or not own[-1] else batch.slice(batch.num_rows - 1)
        last_key = key[-1]


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, d, o, place and around, the bytes of its windows, of each of the anchors asked for of a text.

    Of equal surroundings in a slice the earliest has them; the others are
    known to repeat it and have none.
    """
    for batch in batches:
        for part in slices(batch, "text"):
            raw, offsets = _bytes(part.column("text"))
            asked = part.column("asked")
            owner = np.repeat(np.arange(part.num_rows), asked.value_lengths().to_numpy())
            flat = asked.flatten()
            key, place = flat.field("key").to_numpy(), flat.field("place").to_numpy()
            hot = flat.field("hot").to_numpy(zero_copy_only=False)
            windows = np.where(hot, (place & 255) + 1, 1)
            piece = np.cumsum(windows) // _PIECE
            hashes = Hashes(raw) if hot.any() else None
            data = raw.tobytes()
            edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(key)]
            for a, b in zip(edges, edges[1:], strict=False):
                if b > a:
                    yield _around(part, data, hashes, offsets, owner[a:b], key[a:b], place[a:b], hot[a:b], windows[a:b])


def _around(
    part: pa.RecordBatch, data: bytes, hashes: Hashes | None, offsets: np.ndarray, owner: np.ndarray,
    key: np.ndarray, place: np.ndarray, hot: np.ndarray, windows: np.ndarray,
) -> pa.RecordBatch:
    """Rows of ``_surroundings`` of some anchors.

    An anchor of a hot key has a row for each of its windows, whose key is a
    hash of the window: equal windows meet as equal surroundings do.
    """
    if hot.any():
        anchor = np.repeat(np.arange(len(key)), windows)
        step = np.arange(len(anchor)) - np.repeat(np.cumsum(windows) - windows, windows)
        owner, key, place, hot = owner[anchor], key[anchor].copy(), place[anchor].copy(), hot[anchor]
        first, offset = (place >> 16) + step, ((place >> 8) & 255) - step
        place[hot] = ((first << 16) | (offset << 8))[hot]
        key[hot] = _mixed(hashes.of(offsets[owner[hot]] + first[hot], LENGTH)).view(np.int64)
    begin = offsets[owner] + (place >> 16)
    end = begin + (place & 255) + LENGTH
    around = pa.array([data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())
    d, o = (part.column(n).take(pa.array(owner)).to_numpy() for n in ("d", "o"))
    code = around.dictionary_encode().indices.to_numpy()
    columns = [key, code, d, o, place]
    by = np.lexsort(columns[::-1])
    kind = np.stack(columns)[:, by]
    new = np.concatenate([[True], (kind[:2, 1:] != kind[:2, :-1]).any(axis=0)])
    # rows of one document twice are one
    once = np.concatenate([[True], (kind[:, 1:] != kind[:, :-1]).any(axis=0)])
    whole = np.zeros(len(by), bool)
    whole[by[new]] = True
    stays = np.zeros(len(by), bool)
    stays[by[once]] = True
    # neighbouring windows of hot keys that repeat others are one row
    loose = np.flatnonzero(stays & hot & ~whole)
    if len(loose):
        near = (np.diff(loose) == 1) & (owner[loose[1:]] == owner[loose[:-1]]) & (np.diff(place[loose] >> 16) == 1)
        run = np.cumsum(np.concatenate([[0], ~near]))
        size = np.bincount(run)
        # the low byte of a place holds few
        cut = np.arange(len(loose)) - np.repeat(np.cumsum(size) - size, size)
        starts = np.flatnonzero(cut % 32 == 0)
        stays[loose] = False
        stays[loose[starts]] = True
        place[loose[starts]] += np.diff(np.append(starts, len(loose))) - 1
    around = pc.if_else(pa.array(whole), around, pa.scalar(None, pa.binary()))
    rows = pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(d), pa.array(o), pa.array(place), around], names=["key", "d", "o", "place", "around"]
    )
    return rows.filter(pa.array(stays))


def _spans(d: np.ndarray, o: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(x.astype(np.int64)) for x in (d, o, start, end)]
    return pa.RecordBatch.from_arrays(columns, names=["d", "o", "begin", "finish"])


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans d, o, begin, finish of repeated windows, from surroundings sorted by key, around, d, o, place."""
    held: list[tuple[np.ndarray, pa.Array]] = []  # key, d, o, place as rows; around
    rows = 0
    before: tuple | None = None  # key, around, and the first d, o, place that had them
    for batch in batches:
        known = pc.is_null(batch.column("around"))
        if pc.any(known).as_py():
            d, o, place = (batch.column(n).filter(known).to_numpy() for n in ("d", "o", "place"))
            yield _spans(d, o, place >> 16, (place >> 16) + (place & 255) + LENGTH)
            batch = batch.filter(pc.invert(known))
        if not batch.num_rows:
            continue
        numbers = np.stack([batch.column(n).to_numpy() for n in ("key", "d", "o", "place")])
        around = batch.column("around")
        key = numbers[0]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | pc.not_equal(around.slice(1), around.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
        if before is not None:
            first[0] = not (key[0] == before[0] and around[0].as_py() == before[1])
        # the earliest of equal surroundings; all others repeat it whole
        at = np.maximum.accumulate(np.where(first, np.arange(len(key)), -1))
        earliest = numbers[1:, np.maximum(at, 0)]
        if at[0] < 0:
            earliest[:, at < 0] = np.array(before[2])[:, None]
        again = ~first & (numbers[1:] != earliest).any(axis=0)
        _, d, o, place = numbers[:, again]
        begin = place >> 16
        yield _spans(d, o, begin, begin + (place & 255) + LENGTH)
        before = (key[-1], around[len(key) - 1].as_py(), earliest[:, -1].tolist())
        # groups that are complete, once they are enough
        edge = np.flatnonzero(np.concatenate([[bool(held) and held[-1][0][0, -1] != key[0]], key[1:] != key[:-1]]))
        done = 0
        for cut in (*edge.tolist(), len(key)):
            if cut < len(key) and rows + int(first[done:cut].sum()) < _ROWS:
                continue
            own = np.flatnonzero(first[done:cut]) + done
            if len(own):
                held.append((numbers[:, own], around.take(pa.array(own))))
                rows += len(own)
            done = cut
            if cut < len(key) and held:
                yield from _sorted(held)
                held, rows = [], 0
    if held:
        yield from _sorted(held)


def _sorted(held: list[tuple[np.ndarray, pa.Array]]) -> Iterator[pa.RecordBatch]:
    """Spans of the windows that another of the distinct surroundings of their group has earlier."""
    numbers = np.concatenate([n for n, _ in held], axis=1)
    key = numbers[0]
    same = key[1:] == key[:-1]
    several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    if not several.any():
        return
    around = pa.concat_arrays([a for _, a in held]).filter(pa.array(several))
    key, d, o, place = numbers[:, several]
    raw, offsets = _bytes(around)
    begin, offset, further = place >> 16, (place >> 8) & 255, place & 255
    by = np.lexsort((begin + offset, o, d))
    new = np.zeros(len(by), np.int64)
    for x in (d, o, begin + offset):
        new[1:] |= x[by[1:]] != x[by[:-1]]
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(new)
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
    owner = np.repeat(np.arange(len(key)), further + 1)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(further + 1) - further - 1, further + 1)
    kind = group[owner] * 256 + offset[owner] - step  # equal windows have their anchor at the same place
    windows = np.argsort(kind, kind="stable")
    kinds = kind[windows]
    edges = np.flatnonzero(np.concatenate([[True], kinds[1:] != kinds[:-1], [True]]))
    sizes = np.diff(edges)
    windows = windows[np.repeat(sizes > 1, sizes)]
    kinds = kind[windows]
    flagged = np.zeros(len(owner), bool)
    at = 0
    while at < len(windows):
        end = min(len(windows), at + _WINDOWS)
        if end < len(windows):
            # whole kinds at a time
            end = int(np.searchsorted(kinds, kinds[end - 1], "right"))
        mine = windows[at:end]
        found, equal = order(raw, offsets[owner[mine]] + step[mine], kinds[at:end], LENGTH)
        mine = mine[found]
        heads = np.flatnonzero(~equal)
        least = np.minimum.reduceat(rank[owner[mine]], heads)
        flagged[mine] = rank[owner[mine]] > np.repeat(least, np.diff(np.append(heads, len(mine))))
        at = end
    hit = np.flatnonzero(flagged)
    if not len(hit):
        return
    new = np.concatenate([[True], (np.diff(hit) > 1) | (owner[hit[1:]] != owner[hit[:-1]])])
    first, last = hit[new], hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)]
    who = owner[first]
    yield _spans(d[who], o[who], begin[who] + step[first], begin[who] + step[last] + LENGTH)


def merged(begin: np.ndarray, finish: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans as maximal spans, in order."""
    by = np.argsort(begin, kind="stable")
    begin, finish = begin[by], np.maximum.accumulate(finish[by])
    new = np.concatenate([[True], begin[1:] > finish[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(begin) - 1)
    return begin[new], finish[last]


def _characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``spans`` less the bytes of characters that they hold in part."""
    found = []
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            found.append((a, b))
    return found


def _once(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` on the first row of each document alone: all rows of one are in one partition, repeated or not."""

    def first(batches: Batches) -> Batches:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            known = [p in seen or seen.add(p) for p in zip(batch.column("d").to_pylist(), batch.column("o").to_pylist(), strict=True)]
            if not any(known):
                yield batch
            elif not all(known):
                yield batch.filter(pa.array([not k for k in known]))

    return lambda batches: run(first(batches))


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """text, row (the other columns of ``docs``) and spans (begin, finish) of bytes to remove, of each row.

    All three uses of the texts take all their columns, as one exchange then
    serves them all.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.coalesce(F.col(text), F.lit(""))
    # a document is its id and a hash of its text
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    o = F.xxhash64(own)
    others = F.struct("doc_id", *(c for c in docs.columns if c not in ("doc_id", text))).alias("others")
    rows = docs.select(d.alias("d"), o.alias("o"), own.alias("text"), F.struct(F.col(text).isNull().alias("none"), others).alias("row"))
    texts = rows.repartition(n, "d", "o")
    copies = docs.select(F.md5(own.cast("binary")).alias("digest"), F.struct(d.alias("d"), o.alias("o")).alias("doc"))
    first = copies.groupBy("digest").agg(F.min("doc").alias("doc")).select("doc.d", "doc.o").distinct()
    # an inner join: a semi join would be moved below the exchange, and need one of its own
    unique = texts.join(first.hint("shuffle_hash"), ["d", "o"])
    places = in_arrow(unique, _once(_positions), "key long, d long, o long, place long")
    # what is known already goes anywhere, so that no task gets all rows of a hot key
    anywhere = F.xxhash64("d", "place")
    dealt = F.when(F.col("place").bitwiseAND(F.lit(_KNOWN)) > 0, anywhere).otherwise(F.col("key"))
    again = in_arrow(places.repartition(n, dealt).sortWithinPartitions("key"), _repeated, places.schema)
    # at most _MOST_HOT keys, as a position takes a byte at least; both uses of the positions take one exchange
    most = max(HOT, (docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // _MOST_HOT)
    hot = again.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most).select(F.col("key").alias("k"))
    marked = again.join(F.broadcast(hot), F.col("key") == F.col("k"), "left").withColumn("hot", F.col("k").isNotNull())
    asked = marked.groupBy("d", "o").agg(F.collect_list(F.struct("key", "place", "hot")).alias("asked"))
    wanted = texts.join(asked.hint("shuffle_hash"), ["d", "o"])
    around = in_arrow(wanted, _once(_surroundings), "key long, d long, o long, place long, around binary")
    by = ["key", "around", "d", "o", "place"]
    dealt = F.when(F.col("around").isNull(), anywhere).otherwise(F.col("key"))
    spans = around.repartition(n, dealt).sortWithinPartitions(*by).mapInArrow(
        _resolved, "d long, o long, begin long, finish long"
    )
    marks = first.select("d", "o", F.lit(-1).cast("long").alias("begin"), F.lit(-1).cast("long").alias("finish"))
    found = spans.unionByName(marks).groupBy("d", "o").agg(F.collect_list(F.struct("begin", "finish")).alias("spans"))
    return texts.join(found.hint("shuffle_hash"), ["d", "o"], "left")


def _cleaned(column: pa.Array, spans: pa.Array, whole: bool) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Each text's bytes and maximal spans to remove; ``whole``: no character in part.

    A text that is not the first of its copies has no list of spans, and goes
    whole if a string of the length fits into it.
    """
    lengths = spans.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = spans.flatten()
    begin, finish = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    ends = np.cumsum(np.maximum(lengths, 0))
    for i, text in enumerate(column.cast(pa.binary()).to_pylist()):
        if lengths[i] < 0:
            yield text, [(0, len(text))] if len(text) >= LENGTH else []
            continue
        a, b = begin[ends[i] - lengths[i] : ends[i]], finish[ends[i] - lengths[i] : ends[i]]
        real = a >= 0
        if not real.any():
            yield text, []
            continue
        a, b = merged(a[real], b[real])
        own = list(zip(a.tolist(), b.tolist(), strict=True))
        yield text, _characters(text, own) if whole else own


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def removed(docs: DataFrame) -> DataFrame:
    """``docs`` with texts less their repeats, whole characters only; texts of which nothing is left go."""
    rows = with_spans(docs)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = list(_cleaned(part.column("text"), part.column("spans"), True))
                texts = [_kept(t, s).decode() for t, s in found]
                stays = [bool(new) or not old for new, (old, _) in zip(texts, found, strict=True)]
                columns = [part.column("row"), pa.array(texts, pa.string()), pa.array(stays, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "changed", "stays"])

    fields = [StructField("changed", StringType()), StructField("stays", BooleanType())]
    schema = StructType([rows.schema["row"], *fields])
    found = in_arrow(rows, run, schema)
    text = F.when(~F.col("row.none"), F.col("changed"))
    others = F.col("row.others")
    return found.where("stays").select(*(text.alias(c) if c == "text" else others[c].alias(c) for c in docs.columns))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256."""
    rows = with_spans(docs.select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = list(_cleaned(part.column("text"), part.column("spans"), False))
                columns = [
                    part.column("row").field("others").field("doc_id").cast(pa.int64()),
                    pa.array([len(t) for t, _ in found], pa.int64()),
                    pa.array([sum(b - a for a, b in s) for _, s in found], pa.int64()),
                    pa.array([len(s) for _, s in found], pa.int64()),
                    pa.array([hashlib.sha256(_kept(t, s)).hexdigest() for t, s in found], pa.string()),
                ]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return in_arrow(rows, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
