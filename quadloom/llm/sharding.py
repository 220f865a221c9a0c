"""Shards of near equal bytes by a k-d tree over metadata of documents.

Equal texts are one point of the tree, with the source, language and length of
the row of least doc_id, and stay in one shard. A node that stands for several
shards is cut along its widest dimension at the weighted quantile that gives
each side the bytes of its shards; leaves are the shards. The quantile comes
from histograms over the digits of 62-bit keys, at most ``_BINS`` sums a node,
so no node's rows meet in one task and the driver holds the tree alone.

Points of more than 1/50 of a shard, at most 50 for each shard, are laid first,
the largest into the emptiest shard; the tree then fills up what each shard has
left. A point larger than a shard makes that shard larger than others, since
equal texts stay together.

Slots number the rows of a shard by ascending doc_id. Defined cases: a null
text counts as no bytes and all null texts are one point; null metadata are a
value of their own; a null doc_id comes first; equal ids are in the order of
their texts' hashes and then as they come; extra columns don't matter; an empty
table gives an empty one; with fewer points than shards some shards are empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadloom.llm.common import checkpointed

_DIGIT = 11
_BINS = 1 << _DIGIT
_ROUNDS = 4
_VALUE_BITS, _TIE_BITS = 24, 38  # of a key: the value, then a hash that tells ties apart
_DIMENSIONS = ("source", "lang", "length")
OVERHEAD = 8  # bytes of a row beside its text


@dataclass
class Node:
    """A part of the points: the shards it is for and, once cut, where."""

    shards: list[int]
    dimension: str = ""
    cut: int = 0
    left: Node | None = None
    right: Node | None = None


def _key(value: Column) -> Column:
    """A key of a value below 2^24 whose ties are in the order of a hash of the point."""
    tie = F.shiftrightunsigned(F.xxhash64("point"), 64 - _TIE_BITS)
    return F.shiftleft(value.cast("long"), _TIE_BITS).bitwiseOR(tie)


def rows_of(docs: DataFrame) -> DataFrame:
    """The narrow row of each document: its id, size, checksum, point and metadata."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNull(), F.lit(-1)).otherwise(F.xxhash64("text")).alias("point"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("length"),
    )


def points_of(rows: DataFrame) -> DataFrame:
    """Each point, its bytes and its key in each dimension."""
    first = F.min(F.struct("doc_id", "source", "lang", "length")).alias("first")
    points = rows.groupBy("point").agg(F.sum("size").alias("bytes"), first)
    named = {d: F.shiftrightunsigned(F.xxhash64(F.lit(d), f"first.{d}"), 64 - _VALUE_BITS) for d in ("source", "lang")}
    steps = (1 << _VALUE_BITS) / 40  # lengths by their logarithm, up to 2^40
    named["length"] = F.log2(F.col("first.length") + 1) * steps
    return points.select("point", "bytes", *(_key(v).alias(d) for d, v in named.items()))


def _node(tree: Node, leaf_value) -> Column:
    """``leaf_value(node)`` of the node in which a point is, as far as the tree is cut."""
    if tree.left is None:
        return F.lit(leaf_value(tree))
    left, right = _node(tree.left, leaf_value), _node(tree.right, leaf_value)
    return F.when(F.col(tree.dimension) <= tree.cut, left).otherwise(right)


def _cuts(points: DataFrame, tree: Node, open_nodes: list[Node], room: list[float]) -> None:
    """Cut all ``open_nodes`` along their widest dimensions."""
    number = {id(n): i for i, n in enumerate(open_nodes)}
    inside = points.withColumn("node", _node(tree, lambda n: number.get(id(n), -1))).where("node >= 0")
    edges = [f(F.shiftright(d, _TIE_BITS)).alias(f"{d}_{k}") for d in _DIMENSIONS for k, f in (("a", F.min), ("b", F.max))]
    found = {r["node"]: r for r in inside.groupBy("node").agg(F.sum("bytes").alias("bytes"), *edges).collect()}
    wanted = {}
    for i, node in enumerate(open_nodes):
        half = len(node.shards) // 2
        node.left, node.right = Node(node.shards[:half]), Node(node.shards[half:])
        row = found.get(i)
        node.dimension = max(_DIMENSIONS, key=lambda d: row[f"{d}_b"] - row[f"{d}_a"]) if row else _DIMENSIONS[0]
        space, all_space = sum(room[s] for s in node.left.shards), sum(room[s] for s in node.shards)
        wanted[i] = (row["bytes"] if row else 0) * space / all_space if all_space > 0 else 0
    value = F.lit(0).cast("long")
    for i, node in enumerate(open_nodes):
        value = F.when(F.col("node") == i, F.col(node.dimension)).otherwise(value)
    inside = inside.select("node", "bytes", value.alias("key"))
    prefix, below = dict.fromkeys(wanted, 0), dict.fromkeys(wanted, 0)
    for turn in range(_ROUNDS):
        shift = _VALUE_BITS + _TIE_BITS - _DIGIT * (turn + 1)
        known = F.lit(0).cast("long")
        for i, p in prefix.items():
            known = F.when(F.col("node") == i, F.lit(p).cast("long")).otherwise(known)
        here = inside.where(F.shiftright("key", shift + _DIGIT) == known)
        bins = here.groupBy("node", F.shiftright("key", shift).bitwiseAND(F.lit(_BINS - 1)).alias("bin")).agg(F.sum("bytes").alias("bytes"))
        # the bins of a node, at most 2048, in one window
        total = F.sum("bytes").over(Window.partitionBy("node").orderBy("bin"))
        left = F.create_map(*(x for i in wanted for x in (F.lit(i), F.lit(float(wanted[i] - below[i])))))[F.col("node")]
        reached = bins.withColumn("total", total).where(F.col("total") - F.col("bytes") <= left)
        last = reached.groupBy("node").agg(F.max(F.struct("bin", "total", "bytes")).alias("last")).collect()
        for row in last:
            i, at = row["node"], row["last"]
            prefix[i] = prefix[i] << _DIGIT | at["bin"]
            below[i] += at["total"] - at["bytes"]
            if turn + 1 == _ROUNDS:
                # the last bin goes to the nearer side
                over = below[i] + at["bytes"] - wanted[i]
                take = over <= wanted[i] - below[i]
                open_nodes[i].cut = ((prefix[i] + take) << shift) - 1
        for i in set(prefix) - {r["node"] for r in last}:
            prefix[i] <<= _DIGIT


def assign(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, point, shard and slot of every document."""
    rows = checkpointed(rows_of(docs))
    points = checkpointed(points_of(rows))
    total = points.agg(F.sum("bytes")).first()[0] or 0
    share = total / shards
    # at most 50 for each shard
    large = points.where(F.col("bytes") > share / 50).select("point", "bytes").orderBy(F.desc("bytes"), "point").collect()
    room, held = [share] * shards, {}
    for p in large:
        held[p["point"]] = s = max(range(shards), key=lambda i: (room[i], -i))
        room[s] -= p["bytes"]
    room = [max(r, 0.0) for r in room]
    small = points.where(F.col("bytes") <= share / 50)
    tree = Node(list(range(shards)))
    open_nodes = [tree] if shards > 1 else []
    while open_nodes:
        _cuts(small, tree, open_nodes, room)
        open_nodes = [n for o in open_nodes for n in (o.left, o.right) if len(n.shards) > 1]
    placed = small.select("point", _node(tree, lambda n: n.shards[0]).alias("shard"))
    if held:
        laid = rows.sparkSession.createDataFrame(list(held.items()), "point long, shard int")
        placed = placed.unionByName(laid)
    placed = checkpointed(placed.withColumnRenamed("point", "p"))
    found = rows.join(placed, F.col("point") == F.col("p")).select("doc_id", "size", "text_crc32", "point", "shard")
    return _slots(found)


def _slots(rows: DataFrame) -> DataFrame:
    """``rows`` with their number in the shard: their place among all sorted rows, less that of the shard's first."""
    by = [F.col("shard"), F.col("doc_id").asc_nulls_first(), F.col("point")]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # the number of the task, and in the low 33 bits the row's place in it
    ordered = checkpointed(ordered.withColumn("at", F.monotonically_increasing_id()))
    task, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    ordered = ordered.withColumn("task", task).withColumn("place", place)
    # one row a task
    tasks = ordered.groupBy("task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("task")) - F.col("n")
    ranked = ordered.join(F.broadcast(tasks.select("task", before.alias("before"))), "task")
    ranked = ranked.withColumn("rank", F.col("before") + F.col("place"))
    first = ranked.groupBy("shard").agg(F.min("rank").alias("first"))
    return ranked.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "point", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )


def digests(docs: DataFrame, shards: int = 24) -> DataFrame:
    return assign(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
