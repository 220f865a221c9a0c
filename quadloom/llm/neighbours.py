"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors (``Plan.sample``) gives a neighbour graph, which
is cut into balanced parts by recursive bisection: each part is halved at the
median of a smooth vector over the graph, and pairs of rows then change sides
where that cuts fewer edges. A small network learns the part of a vector from
it and its neighbours' parts. Every vector is indexed in its most probable
part; a query is sent to its several most probable ones and compared with all
vectors there, exactly, in double precision.

Equal vectors are one node with the k + 1 smallest ids, which is all that an
answer can hold of them, so a vector that a third of all rows share costs one
comparison. Parts are cut into blocks of bounded size. What the driver holds is
the sample, the network, and one count a part.

Defined cases: vectors that are null, zero, or hold null or non-finite numbers,
rows without vec_id, and vectors whose length is not the most common one take
no part; rows of one vec_id are no candidates of each other's, and of one vec_id
and vector count once; ties go to the smaller vec_id; a query with fewer than k candidates gets them all; extra
columns don't matter; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadloom.llm.common import checkpointed


@dataclass(frozen=True)
class Plan:
    """What to build and how far to look.

    ``sample``: most rows that the partitions are learned from; ``part_rows``:
    rows that a part should have at least; ``mass``: a query goes to its most
    probable parts until their probabilities sum to this, which is also about
    the share of its neighbours to expect there.
    """

    k: int = 5
    sample: int = 8192
    parts: int = 64
    part_rows: int = 256
    mass: float = 0.92
    neighbours: int = 12
    hidden: int = 128
    epochs: int = 12
    block: int = 4096


def graph(vectors: np.ndarray, neighbours: int) -> np.ndarray:
    """The nearest rows of each row of unit vectors, some rows at a time."""
    found = []
    for at in range(0, len(vectors), 64):
        near = vectors[at : at + 64] @ vectors.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -2
        found.append(np.argpartition(-near, neighbours - 1, axis=1)[:, :neighbours])
    return np.concatenate(found)


def balanced_parts(near: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """The part of each row: ``parts``, a power of two, of sizes at most one apart for each halving."""
    part = np.zeros(len(near), np.int64)
    random = np.random.default_rng(seed)
    size = 1
    while size < parts:
        halves = np.zeros(len(near), np.int64)
        for p in range(size):
            rows = np.flatnonzero(part == p)
            halves[rows] = _halved(near, rows, random)
        part = 2 * part + halves
        size *= 2
    return part


def _halved(near: np.ndarray, rows: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """0 or 1 for each of ``rows``, in equal numbers, with few edges of the graph between."""
    n = len(rows)
    at = np.full(len(near), -1)
    at[rows] = np.arange(n)
    ends = at[near[rows]]
    inside = ends >= 0
    a, b = np.repeat(np.arange(n), near.shape[1])[inside.ravel()], ends[inside]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    degree = np.bincount(a, minlength=n) + 1.0
    x = random.standard_normal(n)
    for _ in range(60):
        x = (x + np.bincount(a, weights=x[b], minlength=n)) / degree
        x -= (x * degree).sum() / degree.sum()
        x /= np.abs(x).max() or 1.0
    side = np.zeros(n, np.int64)
    side[np.argsort(x, kind="stable")[n // 2 :]] = 1
    for _ in range(10):
        other = np.bincount(a, weights=(side[a] != side[b]).astype(float), minlength=n)
        gain = 2 * other - (degree - 1)
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1)
        left, right = left[np.argsort(-gain[left])], right[np.argsort(-gain[right])]
        most = min(len(left), len(right))
        # half of what would gain, since neighbours that both move gain nothing
        moves = int((gain[left[:most]] + gain[right[:most]] > 0).sum()) // 2
        if not moves:
            break
        side[left[:moves]], side[right[:moves]] = 1, 0
    return side


class Router:
    """A network of one hidden layer from unit vectors to the probabilities of parts."""

    def __init__(self, dim: int, hidden: int, parts: int, seed: int = 7):
        random = np.random.default_rng(seed)
        self.weights = [
            random.standard_normal((dim, hidden)) * np.sqrt(2 / dim),
            np.zeros(hidden),
            random.standard_normal((hidden, parts)) * np.sqrt(1 / hidden),
            np.zeros(parts),
        ]

    def scores(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.maximum(x @ a + b, 0) @ c + d

    def fit(self, x: np.ndarray, wanted: np.ndarray, epochs: int, rate: float = 0.003, batch: int = 256, seed: int = 7) -> None:
        """Adam steps on the cross entropy with the wanted distribution of each row."""
        random = np.random.default_rng(seed)
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step = 0
        for epoch in range(epochs):
            order = random.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at : at + batch]
                a, b, c, _ = self.weights
                inner = np.maximum(x[rows] @ a + b, 0)
                out = inner @ c + self.weights[3]
                out = np.exp(out - out.max(axis=1, keepdims=True))
                error = (out / out.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
                back = (error @ c.T) * (inner > 0)
                step += 1
                now = rate * (1 - epoch / epochs)
                for i, g in enumerate((x[rows].T @ back, back.sum(axis=0), inner.T @ error, error.sum(axis=0))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    scaled = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                    self.weights[i] = self.weights[i] - now * scaled


def learn(sample: np.ndarray, plan: Plan, parts: int) -> Router:
    """The router of ``parts`` partitions learned from a sample of vectors."""
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    near = graph(x, min(plan.neighbours, len(x) - 1))
    part = balanced_parts(near, parts)
    wanted = np.zeros((len(x), parts))
    for column in (*near.T, *(np.arange(len(x)),) * 3):
        wanted[np.arange(len(x)), part[column]] += 1
    router = Router(x.shape[1], plan.hidden, parts)
    router.fit(x, wanted / wanted.sum(axis=1, keepdims=True), plan.epochs)
    return router


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    return x / scale / np.linalg.norm(x / scale, axis=1, keepdims=True)


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The cosine of one vector with each row; of the same two vectors always the same number."""
    norms = np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum())
    return (rows * query).sum(axis=1) / norms


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    x = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(finite & F.exists(x, lambda v: v != 0))
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (sizes["n"] if sizes else 0))


def search(vectors: DataFrame, queries: F.Column, plan: Plan = Plan()) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest rows to each row for which ``queries`` holds."""
    spark, k = vectors.sparkSession, plan.k
    rows = checkpointed(valid(vectors))
    nodes = checkpointed(rows.groupBy("embedding").agg(F.min("vec_id").alias("node")))
    n = nodes.count()
    parts = 1
    while parts < plan.parts and 2 * parts * plan.part_rows <= n:
        parts *= 2
    router = None
    if parts > 1:
        # a little less than the sample, so that the limit cuts nothing but the odd row
        share = 1.0 if n <= plan.sample else 0.97 * plan.sample / n
        chosen = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(share * (1 << 30))
        sample = nodes.where(chosen).select("embedding").limit(plan.sample)
        router = learn(np.array([r[0] for r in sample.collect()]), plan, parts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("embedding")
            own = np.zeros(len(x), np.int32)
            if router and len(x):
                unit = _unit(matrix(x, len(x[0])))
                own = router.scores(unit).argmax(axis=1).astype(np.int32)
            yield batch.append_column("part", pa.array(own))

    placed = checkpointed(nodes.mapInArrow(place, "embedding array<double>, node long, part int"))
    counts = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    sizes = np.array([counts.get(p, 0) for p in range(parts)])
    blocks = np.maximum(1, -(-sizes // plan.block))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("embedding")
            if not len(x):
                continue
            scores = router.scores(_unit(matrix(x, len(x[0])))) if router else np.zeros((len(x), 1))
            order = np.argsort(-scores, axis=1, kind="stable")
            share = np.exp(scores - scores.max(axis=1, keepdims=True))
            share = np.take_along_axis(share / share.sum(axis=1, keepdims=True), order, 1)
            probable = (np.cumsum(share, axis=1) < plan.mass).sum(axis=1) + 1
            # further parts where the first ones have too few rows
            enough = (np.cumsum(sizes[order], axis=1) <= k).sum(axis=1) + 1
            probes = np.minimum(np.maximum(enough, probable), parts)
            row = np.repeat(np.arange(len(x)), probes)
            part = order[np.arange(parts)[None, :] < probes[:, None]]
            again = blocks[part]
            row, part = np.repeat(row, again), np.repeat(part, again)
            block = np.arange(len(row)) - np.repeat(np.cumsum(again) - again, again)
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [taken.column("embedding"), taken.column("node"), pa.array(part.astype(np.int32)), pa.array(block.astype(np.int32))],
                names=["embedding", "node", "part", "block"],
            )

    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("x"))
    asked = asked.join(nodes, F.col("x") == F.col("embedding")).select("query_id", "embedding", "node")
    asked = checkpointed(asked.dropDuplicates(["query_id", "node"]))
    schema = "embedding array<double>, node long, part int, block int"
    sent = asked.dropDuplicates(["node"]).select("embedding", "node").mapInArrow(route, schema)
    cut = F.lit(1)
    for p, b in enumerate(blocks.tolist()):
        cut = F.when(F.col("part") == p, F.lit(b)).otherwise(cut) if b > 1 else cut
    lying = placed.select("embedding", "node", "part", F.pmod(F.xxhash64("node"), cut).cast("int").alias("block"))
    both = lying.withColumn("side", F.lit(0)).unionByName(sent.withColumn("side", F.lit(1)))
    tasks = both.repartition("part", "block").sortWithinPartitions("part", "block", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, ids, unit = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("embedding"), len(batch.column("embedding")[0]))
            node = batch.column("node").to_numpy()
            key = np.stack([batch.column(c).to_numpy() for c in ("part", "block", "side")])
            edges = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), len(node)]
            out = [[], [], []]
            for a, b in zip(edges, edges[1:], strict=False):
                if at != (key[0, a], key[1, a]):
                    at, rows, ids, unit = (key[0, a], key[1, a]), [], [], None
                if key[2, a] == 0:
                    rows.append(x[a:b])
                    ids.append(node[a:b])
                    continue
                if not rows:
                    continue
                if unit is None:
                    rows, ids = [np.concatenate(rows)], [np.concatenate(ids)]
                    unit = _unit(rows[0])
                for q in range(a, b, 256):
                    asked = x[q : min(b, q + 256)]
                    near = _unit(asked) @ unit.T
                    m = min(k + 1, near.shape[1])
                    # all that rounding could bring among the first
                    least = -np.partition(-near, m - 1, axis=1)[:, m - 1 : m] - 1e-9
                    for i, j in enumerate(near >= least):
                        j = np.flatnonzero(j)
                        score = cosines(asked[i], rows[0][j])
                        first = np.lexsort((ids[0][j], -score))[: k + 1]
                        out[0].append(np.full(len(first), node[q + i]))
                        out[1].append(ids[0][j][first])
                        out[2].append(score[first])
            if out[0]:
                columns = [pa.array(np.concatenate(c)) for c in out]
                yield pa.RecordBatch.from_arrays(columns, names=["asked", "near", "score"])

    found = tasks.mapInArrow(compare, "asked long, near long, score double")
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "near")
    found = found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1)
    # the k + 1 smallest ids of each vector that was found
    by_id = Window.partitionBy("embedding").orderBy("vec_id")
    members = rows.withColumn("at", F.dense_rank().over(by_id)).where(F.col("at") <= k + 1)
    members = members.groupBy("embedding").agg(F.min("vec_id").alias("near"), F.array_sort(F.collect_set("vec_id")).alias("ids"))
    hits = found.join(members.select("near", "ids"), "near").select("asked", "score", F.explode("ids").alias("vec_id"))
    # at most (k + 1)^2 rows of each query's vector
    lists = hits.groupBy("asked").agg(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id")).alias("hits"))
    ranked = asked.join(lists, F.col("node") == F.col("asked")).select(
        "query_id",
        F.slice(F.filter(F.array_sort("hits"), lambda h: h["vec_id"] != F.col("query_id")), 1, k).alias("hits"),
    )
    return ranked.select("query_id", F.posexplode("hits").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.less")).alias("score"),
    )
