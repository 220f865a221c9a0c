"""Near-duplicates by SimHash fingerprints, compared exactly in tiles.

A fingerprint has bit b set if over half of the hashes of a text's word
shingles, repeats included, have it. Fingerprints are linked if they differ in
``radius`` bits or fewer. Distinct fingerprints are laid in tiles of bounded
size, ordered by their number of set bits; a pair of tiles is compared by
exclusive-or and bit counts in numpy, and skipped if the numbers of set bits
are further apart than the radius.

Comparing all tiles with all would grow with the square of the table, so tiles
are cut from groups that share a key. ``by_blocks``: the bits are cut into
radius + 1 blocks and a fingerprint is in the group of each of its blocks. Two
fingerprints within the radius agree in a block at least, so no link is lost.

A group of more than ``TILE`` fingerprints becomes several tiles, and its pairs
of tiles go to different tasks. Of the links of a pair of tiles only a spanning
forest leaves the task, so no group is emitted as all its pairs.

``one_of_each`` links texts by the similarity of their sets of shingles. A text
is in the groups of ``keys`` minima of its re-hashed shingles; sets of similarity
s share one with probability 1 - (1 - s) ** keys. Tiles hold sketches: the size
of a set, the minima, and one bit each of ``BITS`` further minima, of which two
sets differ in each with probability (1 - s) / 2. Links are the pairs that an
exact check of the sets confirms; only confirmed links are thinned to forests:

1. The closest forest of each pair of tiles is checked, which connects most of
   what is connected.
2. All other pairs of a pair of tiles whose ends are not connected yet meet
   there again with their texts, and are checked until they are connected.

Defined cases: texts of fewer words than a shingle have their whole sequence as
one; texts without words, null or empty, have fingerprint zero and are linked
like any other; a null doc_id takes part and is no component's id unless all
of its component are null; repeated rows and ids each get their row; extra
columns don't matter; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quadloom.llm.common import checkpointed, fresh, in_arrow, on_slices
from quadloom.llm.components import components

SEED = 42
TILE = 2048
_ROWS = 256  # rows of a tile compared at a time
BITS = 128  # one-bit minima of a sketch
_WEIGHT = 1024  # shingles that count as one row of a tile
_PART = 4096  # shingles re-hashed at a time


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of the shingles of ``words`` words of a text, in lower case (A-Z alone), repeats included."""
    own = (text or "").encode().lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    joined = b" ".join(own)
    if len(own) < words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(own) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)]
    return np.array(found, np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The fingerprint as a signed 64-bit number."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(most, bitorder="little").tobytes(), "little", signed=True)


def _factors(n: int) -> np.ndarray:
    """``n`` odd 64-bit numbers."""
    return np.array([xxhash.xxh64_intdigest(str(i), SEED) | 1 for i in range(n)], np.uint64)


def minima(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """For each factor the least re-hashed shingle, as unsigned numbers."""
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), _PART):
        with np.errstate(over="ignore"):
            found = hashes[None, at : at + _PART] * factors[:, None]
            found ^= found >> np.uint64(29)
            found *= factors[:, None]
        least = np.minimum(least, found.min(axis=1))
    return least


def fingerprints(docs: DataFrame, words: int, ids: Sequence[str] = ("doc_id",)) -> DataFrame:
    """fp of each row, beside the whole numbers ``ids``."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            prints = [fingerprint(shingle_hashes(text, words)) for text in batch.column("text").to_pylist()]
            own = {name: batch.column(name) for name in ids}
            return pa.RecordBatch.from_pydict(own | {"fp": pa.array(prints, pa.int64())})

        return one

    rows = docs.select(*(F.col(name).cast("long").alias(name) for name in ids), "text")
    return on_slices(rows, "text", make, ", ".join(f"{name} long" for name in (*ids, "fp")))


def sketch(shingles: np.ndarray, factors: np.ndarray, keys: int) -> np.ndarray:
    """Of distinct shingles: their number, one-bit minima, and ``keys`` minima, as unsigned numbers."""
    least = minima(shingles, factors) if len(shingles) else np.zeros(len(factors), np.uint64)
    bits = ((least[keys:] >> np.uint64(17)) & np.uint64(1)).astype(np.uint8)
    return np.concatenate([np.array([len(shingles)], np.uint64), np.packbits(bits).view(np.uint64), least[:keys]])


def sketches(docs: DataFrame, words: int, keys: int) -> DataFrame:
    """d, h (a hash of the text), node (a hash of the set of shingles), size, sketch and minima of each row."""
    factors = _factors(keys + BITS)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            nodes, own = [], []
            for text in batch.column("text").to_pylist():
                shingles = np.unique(shingle_hashes(text, words))
                nodes.append(xxhash.xxh64_intdigest(shingles.tobytes(), SEED) - (1 << 63))
                own.append(sketch(shingles, factors, keys))
            columns = {
                "d": batch.column("d"),
                "h": batch.column("h"),
                "node": pa.array(nodes, pa.int64()),
                "size": pa.array([int(x[0]) for x in own], pa.int64()),
                "sketch": pa.array([x.tobytes() for x in own], pa.binary()),
                "minima": pa.array([x[-keys:].view(np.int64) for x in own], pa.list_(pa.int64())),
            }
            return pa.RecordBatch.from_pydict(columns)

        return one

    schema = "d long, h long, node long, size long, sketch binary, minima array<bigint>"
    return on_slices(docs.select("d", "h", "text"), "text", make, schema)


def by_blocks(radius: int) -> F.Column:
    """The keys of column ``fp`` by blocks: number of the block and its bits."""
    blocks = radius + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return F.array(
        *(
            F.shiftrightunsigned(F.col("fp"), a).bitwiseAND(F.lit((1 << (b - a)) - 1)) * blocks + i
            for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
        )
    )


def _forest(a: np.ndarray, b: np.ndarray, gap: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the links of a spanning forest, closest first."""
    root = list(range(n))
    kept = []
    order = np.argsort(gap, kind="stable")
    for k, i, j in zip(order.tolist(), a[order].tolist(), b[order].tolist(), strict=True):
        while root[i] != i:
            root[i] = i = root[root[i]]
        while root[j] != j:
            root[j] = j = root[root[j]]
        if i != j:
            root[max(i, j)] = min(i, j)
            kept.append(k)
    return np.array(kept, np.int64)


def compare(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A spanning forest of the links of a pair of tiles, or of one tile with itself (``right`` None).

    Gives places in ``left``, places in ``right`` and differing bits. Rows are
    taken in order of their set bits, some hundred at a time; links within what
    is already connected are passed over.
    """
    own = right is None
    set_left = np.bitwise_count(left).astype(np.int16)
    order = np.argsort(set_left, kind="stable")
    if own:
        right, set_right, order_right, offset = left, set_left, order, 0
    else:
        set_right = np.bitwise_count(right).astype(np.int16)
        order_right, offset = np.argsort(set_right, kind="stable"), len(left)
    sorted_right, counts_right = right[order_right], set_right[order_right]
    total = offset + len(right)
    label = np.arange(total)
    found = [np.zeros((3, 0), np.int64)]
    for at in range(0, len(left), _ROWS):
        rows = order[at : at + _ROWS]
        low = np.searchsorted(counts_right, int(set_left[rows[0]]) - radius, "left")
        high = np.searchsorted(counts_right, int(set_left[rows[-1]]) + radius, "right")
        low = max(low, at) if own else low
        if low >= high:
            continue
        gaps = np.bitwise_count(left[rows][:, None] ^ sorted_right[None, low:high])
        i, j = np.nonzero(gaps <= radius)
        gap = gaps[i, j].astype(np.int64)
        i, j = rows[i], order_right[low + j] + offset
        new = label[i] != label[j]
        if not new.any():
            continue
        i, j, gap = i[new], j[new], gap[new]
        kept = _forest(i, j, gap, total)
        found.append(np.stack([i[kept], j[kept], gap[kept]]))
        for x, y in zip(i[kept], j[kept], strict=True):
            if label[x] != label[y]:
                label[label == max(label[x], label[y])] = min(label[x], label[y])
    i, j, gap = np.concatenate(found, axis=1)
    kept = _forest(i, j, gap, total)
    return i[kept], j[kept] - offset, gap[kept]


def tiled(rows: DataFrame, reach: int, weight: F.Column | None = None) -> DataFrame:
    """key, i, j, side and the columns of ``rows`` (key, node, ones and others) but ones, for each pair of tiles i, j.

    Tiles are cut in the order of ``ones``, which has few values; pairs are left
    out if all of theirs are over ``reach`` apart. ``weight``, of a row by its
    ones, counts for the size of a tile.
    """
    others = [c for c in rows.columns if c not in ("key", "ones")]
    weight = F.lit(1) if weight is None else weight
    counts = rows.groupBy("key", "ones").agg(F.count("*").alias("rows"))
    # at most a hundred rows a key
    of_key = Window.partitionBy("key")
    before = of_key.orderBy("ones").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("weight", weight).withColumn("n", F.col("rows") * F.col("weight"))
    counts = checkpointed(
        counts.select(
            F.col("key").alias("k"),
            F.col("ones").alias("o"),
            "rows",
            "weight",
            "n",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
            F.sum("n").over(of_key).alias("all"),
            F.sum("rows").over(of_key).alias("all_rows"),
        ).where("all_rows > 1")
    )
    large = counts.where(F.col("all") > TILE)
    # keys of one tile are whole groups; keys of one row have no links
    small = counts.where(F.col("all") <= TILE).select("k").distinct()
    whole = rows.join(small, F.col("key") == F.col("k"), "left_semi").select(
        "key", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), *others
    )
    placed = rows.join(large, (F.col("key") == F.col("k")) & (F.col("ones") == F.col("o"))).select(
        "key", *others,
        ((F.col("before") + F.pmod(F.xxhash64("node"), F.col("rows")) * F.col("weight")) / TILE).cast("int").alias("t"),
    )
    tiles = large.select(
        "k", "o", F.explode(F.sequence((F.col("before") / TILE).cast("int"), ((F.col("before") + F.col("n") - 1) / TILE).cast("int"))).alias("tile")
    ).groupBy("k", "tile").agg(F.min("o").alias("least"), F.max("o").alias("most"))
    other = tiles.select(F.col("k").alias("k2"), F.col("tile").alias("j"), F.col("least").alias("least2"))
    near = (F.col("tile") <= F.col("j")) & (F.col("least2") <= F.col("most") + reach)
    pairs = tiles.join(other, (F.col("k") == F.col("k2")) & near).select("k", F.col("tile").alias("i"), "j")
    sides = pairs.select("k", "i", "j", F.col("i").alias("tile"), F.lit(0).alias("side")).unionByName(
        pairs.where("i < j").select("k", "i", "j", F.col("j").alias("tile"), F.lit(1).alias("side"))
    )
    split = placed.join(sides, (F.col("key") == F.col("k")) & (F.col("t") == F.col("tile")))
    return whole.unionByName(split.select("key", "i", "j", "side", *others))


def tile_links(nodes: DataFrame, keys: F.Column, radius: int) -> DataFrame:
    """Links u, v between rows of ``nodes`` (node, fp and what ``keys`` needs) that share a key."""
    rows = nodes.select("node", "fp", F.explode(keys).alias("key")).withColumn("ones", F.bit_count("fp"))
    work = tiled(rows, radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        out: list[np.ndarray] = []

        def close() -> None:
            if not kept:
                return
            rows = np.concatenate(kept, axis=1)
            kept.clear()
            node, fp = rows[4], rows[5].view(np.uint64)
            second = rows[3] == 1
            if rows[1, 0] == rows[2, 0]:
                a, b, gap = compare(fp, None, radius)
                out.append(np.stack([node[a], node[b], gap]))
            else:
                a, b, gap = compare(fp[~second], fp[second], radius)
                out.append(np.stack([node[~second][a], node[second][b], gap]))

        def made() -> pa.RecordBatch:
            u, v, gap = np.concatenate([np.zeros((3, 0), np.int64), *out], axis=1)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(gap)], names=["u", "v", "gap"])

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)])
            new = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0)) + 1
            edges = [0, *new.tolist(), rows.shape[1]]
            for a, b in zip(edges, edges[1:], strict=False):
                if kept and (kept[-1][:3, -1] != rows[:3, a]).any():
                    close()
                if b > a:
                    kept.append(rows[:, a:b])
            yield made()
        close()
        yield made()

    tasks = work.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
    return in_arrow(tasks, run, "u long, v long, gap long").distinct()


def _roots(prints: DataFrame, radius: int) -> DataFrame:
    """Each distinct fingerprint ``p`` of ``prints`` and the ``root`` of its component."""
    nodes = checkpointed(prints.select(F.col("fp").alias("node"), "fp").distinct())
    links = tile_links(nodes, by_blocks(radius), radius)
    roots = components(links.select("u", "v"))
    return nodes.join(roots, nodes["fp"] == roots["u"], "left").select(F.col("fp").alias("p"), F.coalesce("v", "fp").alias("root"))


def near_copies(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id that links of the radius reach."""
    prints = checkpointed(fingerprints(docs, words))
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    with_root = least.join(_roots(prints, radius), F.col("fp") == F.col("p"))
    ids = with_root.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = with_root.join(ids, "root").select("p", "component_id")
    return prints.join(of_print, F.col("fp") == F.col("p")).select("doc_id", "fp", "component_id")


def one_of_component(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one document of each component of ``near_copies``.

    That of least doc_id stays, of several with it the one whose text has the
    least hash, of repeated rows any one. Rows without doc_id stay.
    """
    names = fresh(docs, "d", "h", "several")
    d, h, _ = names
    real = _numbered(docs, d, h)
    rows = checkpointed(fingerprints(real.select(F.col(d).alias("d"), F.col(h).alias("h"), "text"), words, ("d", "h")))
    least = rows.groupBy("fp").agg(F.min(F.struct("d", "h")).alias("doc"))
    kept = least.join(_roots(rows, radius), F.col("fp") == F.col("p")).groupBy("root").agg(F.min("doc").alias("doc"))
    return _chosen(docs, real, kept, rows, names)


def _numbered(docs: DataFrame, d: str, h: str) -> DataFrame:
    """Documents with an id: that and a hash of their text, by which they are known."""
    return docs.where("doc_id is not null").withColumns({d: F.col("doc_id").cast("long"), h: F.xxhash64(F.coalesce("text", F.lit("")))})


def _chosen(docs: DataFrame, real: DataFrame, kept: DataFrame, rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows of ``docs`` that ``kept`` (doc: d, h) names, one of each, and those without doc_id."""
    d, h, several = names
    repeated = rows.groupBy("d", "h").agg((F.count("*") > 1).alias("several"))
    kept = kept.select("doc.d", "doc.h").join(repeated, ["d", "h"]).select(
        F.col("d").alias(f"{d}_k"), F.col("h").alias(f"{h}_k"), F.col("several").alias(several)
    )
    found = real.join(checkpointed(kept), (F.col(d) == F.col(f"{d}_k")) & (F.col(h) == F.col(f"{h}_k")))
    once = found.where(~F.col(several)).unionByName(found.where(several).dropDuplicates([d, h]))
    return once.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def similar(links: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Links u, v between nodes whose shingle sets have at least the similarity (shared by all)."""
    texts = texts.select(F.col("node").alias("d"), F.col("text").alias("t"))
    sides = links.join(texts, F.col("u") == F.col("d")).select("u", "v", F.col("t").alias("a"))
    sides = sides.join(texts, F.col("v") == F.col("d")).select("u", "v", "a", F.col("t").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = (np.unique(shingle_hashes(s, words)) for s in (a, b))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared >= similarity * (len(x) + len(y) - shared))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return sides.mapInArrow(run, "u long, v long")


class _Pair:
    """A pair of tiles as it is read: node, label, number of the key, sketch and, where there are texts, set of each row."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        self.rows = table
        self.own = table["i"][0].as_py() == table["j"][0].as_py()
        self.side = table["side"].to_numpy()
        self.node = table["node"].to_numpy()
        self.label = np.unique(table["label"].to_numpy(), return_inverse=True)[1]
        data = b"".join(table["sketch"].to_pylist())
        self.sketch = np.frombuffer(data, np.uint64).reshape(table.num_rows, -1)
        self.index = table["index"][0].as_py()

    def candidates(self, radius: int, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers of two rows and their differing bits, for pairs that may be similar and share no key before this one.

        Rows are taken some hundred at a time, and of different labels at that moment.
        """
        n_bits = BITS // 64
        size, bits, least = self.sketch[:, 0].astype(np.int64), self.sketch[:, 1 : 1 + n_bits], self.sketch[:, 1 + n_bits :]
        left, right = (np.arange(len(size)),) * 2 if self.own else (np.flatnonzero(self.side == x) for x in (0, 1))
        for at in range(0, len(left), _ROWS):
            a = left[at : at + _ROWS]
            gap = sum(np.bitwise_count(bits[a, x][:, None] ^ bits[right, x][None]).astype(np.int16) for x in range(n_bits))
            x, j = np.nonzero(gap <= radius)
            i, j, gap = a[x], right[j], gap[x, j]
            fits = (self.label[i] != self.label[j]) & (np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]))
            fits &= (i < j) if self.own else True
            i, j, gap = i[fits], j[fits], gap[fits]
            fits = ~(least[i, : self.index] == least[j, : self.index]).any(axis=1)
            yield i[fits], j[fits], gap[fits].astype(np.int64)

    def closest(self, radius: int, similarity: float) -> pa.RecordBatch:
        """The closest spanning forest of the candidates, not checked yet."""
        found = [np.zeros((3, 0), np.int64)]
        for i, j, gap in self.candidates(radius, similarity):
            kept = _forest(i, j, gap, len(self.node))
            found.append(np.stack([i[kept], j[kept], gap[kept]]))
        i, j, gap = np.concatenate(found, axis=1)
        kept = _forest(i, j, gap, len(self.node))
        return pa.RecordBatch.from_arrays([pa.array(self.node[i[kept]]), pa.array(self.node[j[kept]])], names=["u", "v"])

    def open(self, radius: int, similarity: float) -> list[pa.RecordBatch]:
        """The rows that have candidates."""
        some = np.zeros(len(self.node), bool)
        for i, j, _ in self.candidates(radius, similarity):
            some[i] = some[j] = True
        return self.rows.filter(pa.array(some)).select(_OPEN).combine_chunks().to_batches()

    def confirmed(self, radius: int, similarity: float) -> pa.RecordBatch:
        """A spanning forest of the candidates that the exact check confirms, between labels."""
        sizes = self.rows["shingles"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = self.rows["shingles"].combine_chunks().flatten().to_numpy()
        names, codes = np.unique(flat, return_inverse=True)
        ends = np.cumsum(sizes)
        own = [codes[b - n : b] for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        mark = np.zeros(len(names), bool)
        kept = []
        for i, j, _ in self.candidates(radius, similarity):
            edges = [0, *(np.flatnonzero(np.diff(i)) + 1).tolist(), len(i)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                x, ys = i[a], j[a:b]
                ys = ys[self.label[ys] != self.label[x]]
                if not len(ys):
                    continue
                mark[own[x]] = True
                lengths = sizes[ys]
                shared = np.add.reduceat(mark[np.concatenate([own[y] for y in ys])].astype(np.int64), np.cumsum(lengths) - lengths)
                mark[own[x]] = False
                for y in ys[shared >= similarity * (sizes[x] + lengths - shared)].tolist():
                    if self.label[x] != self.label[y]:
                        kept.append((x, y))
                        self.label[self.label == self.label[y]] = self.label[x]
        label = self.rows["label"].to_numpy()
        u, v = (label[[k[side] for k in kept]] if kept else np.zeros(0, np.int64) for side in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _on_pairs(work: DataFrame, one: Callable[[_Pair], list[pa.RecordBatch]], schema: str | StructType, prepare: Callable | None = None) -> DataFrame:
    """``one`` of each pair of tiles; ``prepare`` of each batch before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            batch = prepare(batch) if prepare else batch
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("key", "i", "j")])
            new = np.flatnonzero((rows[:, 1:] != rows[:, :-1]).any(axis=0)) + 1
            edges = [0, *new.tolist(), rows.shape[1]]
            for a, b in zip(edges, edges[1:], strict=False):
                if held and (last != rows[:, a]).any():
                    yield from one(_Pair(held)) if sum(map(len, held)) > 1 else ()
                    held = []
                held.append(batch.slice(a, b - a))
                last = rows[:, a]
        if sum(map(len, held)) > 1:
            yield from one(_Pair(held))

    tasks = work.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
    return tasks.mapInArrow(run, schema)


_OPEN = ["key", "i", "j", "side", "node", "label", "index", "sketch"]


def _confirmed(nodes: DataFrame, texts: Callable, words: int, similarity: float, radius: int) -> DataFrame:
    """``nodes`` (node, size, sketch, minima) to node and root: the least node of all that confirmed links reach."""
    # sizes of similar sets differ by one class at most
    kind = F.floor(F.log(F.greatest("size", F.lit(1))) / float(-np.log(similarity)) + 1e-9).cast("int")
    weight = F.least(F.lit(TILE), F.ceil(F.pow(F.lit(1 / similarity), F.col("ones") + 1) / _WEIGHT)).cast("long")

    def work(labelled: DataFrame) -> DataFrame:
        rows = labelled.select("node", "label", "sketch", kind.alias("ones"), F.posexplode("minima").alias("index", "m"))
        return tiled(rows.withColumn("key", F.xxhash64("m", "index")).drop("m"), 1, weight)

    first = _on_pairs(work(nodes.withColumn("label", F.col("node"))), lambda p: [p.closest(radius, similarity)], "u long, v long")
    links = checkpointed(first.distinct())
    asked = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    roots = components(similar(links, texts(asked), words, similarity)).select(F.col("u").alias("k"), F.col("v").alias("r"))
    labelled = nodes.join(roots, F.col("node") == F.col("k"), "left").select(*nodes.columns, F.coalesce("r", "node").alias("label"))
    labelled = checkpointed(labelled)
    tiles = work(labelled).select(*_OPEN)
    rest = checkpointed(_on_pairs(tiles, lambda p: p.open(radius, similarity), tiles.schema))

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [np.unique(shingle_hashes(t, words)) for t in batch.column("text").to_pylist()]
        at = batch.schema.get_field_index("text")
        return batch.set_column(at, "shingles", pa.array(own, pa.large_list(pa.uint64())))

    own = texts(rest.select("node").distinct()).select(F.col("node").alias("k"), "text")
    met = rest.join(own, F.col("node") == F.col("k")).drop("k")
    more = components(_on_pairs(met, lambda p: [p.confirmed(radius, similarity)], "u long, v long", sets))
    return labelled.join(more, F.col("label") == F.col("u"), "left").select("node", F.coalesce("v", "label").alias("root"))


def one_of_each(docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 34, keys: int = 8) -> DataFrame:
    """``docs`` with one document of each group of near copies: that of least doc_id, and of least hash of the text.

    Texts of one set of shingles are one group. Else links are pairs that an
    exact check of these sets confirms. One row of each document that is kept
    stays, any one of those of the same doc_id and text. Rows without doc_id stay.
    """
    names = fresh(docs, "d", "h", "several")
    d, h, _ = names
    real = _numbered(docs, d, h)
    bare = real.select(F.col(d).alias("d"), F.col(h).alias("h"), "text")
    rows = checkpointed(sketches(bare, words, keys))
    nodes = rows.groupBy("node").agg(
        F.min(F.struct("d", "h")).alias("doc"), *(F.first(c).alias(c) for c in ("size", "sketch", "minima"))
    )
    nodes = checkpointed(nodes)

    def texts(asked: DataFrame) -> DataFrame:
        """node and text of the nodes asked for."""
        ids = nodes.join(asked, "node", "left_semi").select("node", "doc.d", "doc.h")
        return bare.join(ids, ["d", "h"]).select("node", "text").dropDuplicates(["node"])

    roots = _confirmed(nodes.select("node", "size", "sketch", "minima"), texts, words, similarity, radius)
    kept = nodes.select("node", "doc").join(roots, "node").groupBy("root").agg(F.min("doc").alias("doc"))
    return _chosen(docs, real, kept, rows, names)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hexadecimal and component_id."""
    return near_copies(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
