"""Quality by ordinal regression with cumulative links on graded ratings.

A rating is a grade 0, 1, 2, ... One weight for each hashed feature of a text
gives its score s; ordered thresholds t give P(grade <= g) = 1 / (1 + exp(s - t_g)),
so the grades share their weights. Expected grade and the probability of the
highest grade come from the same numbers, and the latter selects.

Features, all hashed into one space: each word that occurs, in lower case and
without marks at its ends, and the form of the text in steps (shares of words
in capitals, with signs, of one letter, of repeated words and lines; length).

The model is learned on a bounded sample of rated rows, ``Plan.sample``, chosen
by a hash of their ids; their features are made by tasks, and the driver fits
weights with an absolute penalty, so that most are zero. Rating and scoring of
all rows run in tasks.

Defined cases: a null or empty text has the features of form alone; without
rated rows every grade is as likely as any other; ratings without a text or of
a null grade are not used; of several ratings of a document the lowest counts;
repeated rows and extra columns pass unchanged; columns that have the names of
the results are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from quadloom.llm.common import fresh, on_slices, slices
from quadloom.llm.repetition import words_of

_SLICE = 1 << 20  # bytes of text whose features are made at a time
_MARKS = ".,;:!?\"'()[]{}#*$%&|<>-"


@dataclass(frozen=True)
class Plan:
    """``sample``: most rated rows to learn from; ``least``: of the sample that must have a feature."""

    sample: int = 12_000
    buckets: int = 1 << 20
    least: int = 3
    penalty: float = 1e-4
    rounds: int = 300
    grades: int = 3
    accept: float = 0.5


@dataclass
class Model:
    """Weights of the features that have one, and the thresholds between grades."""

    buckets: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    n_buckets: int


def _bucket(name: str, buckets: int) -> int:
    return xxhash.xxh64_intdigest(name) % buckets


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of each feature that occurs, words perhaps more than once."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    offsets, codes, words = words_of(texts)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    plain = pc.utf8_trim(pc.utf8_lower(words), characters=_MARKS)
    hashed = np.fromiter((_bucket(w, buckets) for w in plain.to_pylist()), np.int64, len(words))

    def share(of_word: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=of_word[codes], minlength=n)

    count = np.diff(offsets)
    lower, upper = (f(words) for f in (pc.utf8_lower, pc.utf8_upper))
    capital = pc.and_(pc.not_equal(words, lower), pc.equal(words, upper))
    first = np.zeros(len(codes), bool)
    first[np.unique(owner * max(1, len(words)) + codes, return_index=True)[1]] = True
    lines = pc.split_pattern(texts, pattern="\n")
    line = lines.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line_owner = np.repeat(np.arange(n), np.diff(lines.offsets.to_numpy()))
    per_line = np.unique(line_owner * (len(line) + 1) + line) // (len(line) + 1)
    n_lines = np.bincount(line_owner, minlength=n)
    forms = {
        "capitals": share(capital.to_numpy(zero_copy_only=False)),
        "signs": share(pc.match_substring_regex(words, pattern=r"[#*$%&|<>]").to_numpy(zero_copy_only=False)),
        "calls": share(pc.ends_with(words, pattern="!!").to_numpy(zero_copy_only=False)),
        "letters": share(pc.equal(pc.utf8_length(words), 1).to_numpy(zero_copy_only=False)),
        "distinct": np.bincount(owner, weights=first, minlength=n),
    }
    steps = {name: np.ceil(10 * x / np.maximum(count, 1)).astype(int) for name, x in forms.items()}
    steps["lines"] = np.ceil(10 * np.bincount(per_line, minlength=n) / np.maximum(n_lines, 1)).astype(int)
    steps["length"] = np.ceil(np.log2(count + 1)).astype(int)
    form = [np.fromiter((_bucket(f"{name}={s}", buckets) for s in x.tolist()), np.int64, n) for name, x in steps.items()]
    at = [owner, *(np.arange(n) for _ in form)]
    return np.concatenate(at), np.concatenate([hashed[codes], *form])


def fit(rows: list[np.ndarray], grades: np.ndarray, plan: Plan) -> Model:
    """Weights and thresholds for the feature lists of rated rows, by accelerated proximal steps."""
    none = np.zeros(0, np.int64)
    cuts = np.linspace(-1, 1, plan.grades - 1) if plan.grades > 2 else np.zeros(1)
    if not len(rows):
        even = np.arange(1, plan.grades) / plan.grades
        return Model(none, np.zeros(0), np.log(even / (1 - even)), plan.buckets)
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.concatenate(rows)
    used, counts = np.unique(flat, return_counts=True)
    often = counts >= plan.least
    used = used[often]
    at = np.minimum(np.searchsorted(used, flat), max(0, len(used) - 1))
    keep = used[at] == flat if len(used) else np.zeros(len(flat), bool)
    at, owner = at[keep].astype(np.int32), np.repeat(np.arange(len(rows), dtype=np.int32), sizes)[keep]
    del flat, keep
    n, y = len(rows), np.asarray(grades)
    weights, ahead, pace = np.zeros(len(used)), np.zeros(len(used)), 1.0
    moment = np.full(len(used), 1e-8)
    for turn in range(plan.rounds):
        score = np.bincount(owner, weights=ahead[at], minlength=n)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        upper, lower = (1 / (1 + np.exp(np.clip(score - edges[y + i], -40, 40))) for i in (1, 0))
        upper, lower = np.where(y == plan.grades - 1, 1.0, upper), np.where(y == 0, 0.0, lower)
        slope = (1 - upper - lower) / n
        gradient = np.bincount(at, weights=slope[owner], minlength=len(used))
        moment = np.maximum(moment, gradient * gradient)
        step = 0.3 / (np.sqrt(moment) * np.sqrt(turn + 1) + 1e-6)
        # the longer step of rare features is bounded by their curvature
        step = np.minimum(step, 40.0 / np.maximum(counts[often] / n, 1e-3) / np.sqrt(sizes.mean()))
        moved = ahead - step * gradient
        moved = np.sign(moved) * np.maximum(np.abs(moved) - step * plan.penalty, 0)
        following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = moved + (pace - 1) / following * (moved - weights)
        weights, pace = moved, following if turn % 50 < 49 else 1.0
        mass = np.maximum(upper - lower, 1e-12)
        for g in range(plan.grades - 1):
            bend = 1 / (1 + np.exp(np.clip(score - cuts[g], -40, 40)))
            density = bend * (1 - bend) / mass
            pull = (np.where(y == g, -density, 0) + np.where(y == g + 1, density, 0)).mean()
            cuts[g] -= 0.5 * pull
        cuts = np.maximum.accumulate(cuts + 1e-6 * np.arange(len(cuts)))
    chosen = weights != 0
    return Model(used[chosen].astype(np.int64), weights[chosen], cuts, plan.buckets)


def tails(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade > g) for each threshold, a column each."""
    return 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -700, 700)))


def score(model: Model, texts: pa.Array) -> np.ndarray:
    owner, bucket = features(texts, model.n_buckets)
    weights = np.zeros(len(model.buckets) + 1)
    weights[:-1] = model.weights
    at = np.searchsorted(model.buckets, bucket)
    at[at == len(model.buckets)] = -1
    hit = np.zeros(len(at), bool) if not len(model.buckets) else model.buckets[at] == bucket
    pairs = np.unique(owner[hit] * len(weights) + at[hit]) if hit.any() else np.zeros(0, np.int64)
    return np.bincount(pairs // len(weights), weights=weights[pairs % len(weights)], minlength=len(texts))


def learn(docs: DataFrame, ratings: DataFrame, plan: Plan = Plan()) -> Model:
    """The model of a sample of ``ratings`` (doc_id, grade) and the texts of ``docs``."""
    rated = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    # at most plan.sample rows, which may be sent to every task
    sample = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(plan.sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", _SLICE)):
            owner, bucket = features(batch.column("text"), plan.buckets)
            pairs = np.unique(owner * plan.buckets + bucket)
            ends = np.searchsorted(pairs // plan.buckets, np.arange(batch.num_rows + 1)).tolist()
            found = (pairs % plan.buckets).astype(np.int32)
            lists = pa.array([found[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), lists], names=["doc_id", "grade", "f"])

    made = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("int").alias("grade"), "text")
    rows = sorted(made.mapInArrow(run, "doc_id long, grade int, f binary").collect())
    return fit([np.frombuffer(r[2], np.int32) for r in rows], np.array([r[1] for r in rows], np.int64), plan)


RATED = ("expected_grade", "tail_probability", "kept")


def rate(df: DataFrame, model: Model, accept: float, text: str = "text", names: tuple[str, ...] = RATED) -> DataFrame:
    """``df`` with expected grade, probability of the highest grade, and whether that reaches ``accept``."""
    taken = {n.lower() for n in names}
    own = [f for f in df.schema if f.name.lower() not in taken]
    all_names = [*(f.name for f in own), *names]

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            above = tails(score(model, batch.column(text)), model.thresholds)
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n.lower() not in taken]
            found = [above.sum(axis=1), above[:, -1], above[:, -1] >= accept]
            return pa.RecordBatch.from_arrays([*kept, *map(pa.array, found)], names=all_names)

        return one

    types = (DoubleType(), DoubleType(), BooleanType())
    return on_slices(df, text, make, StructType([*own, *(StructField(n, t) for n, t in zip(names, types, strict=True))]), _SLICE)


def graded(labels: DataFrame) -> DataFrame:
    """Ratings of labels: 0 toxic, 1 of poor quality, 2 good."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("toxic") == 0) & (F.col("quality") == 1), 2)
    return labels.select("doc_id", grade.alias("grade"))


def accepted(docs: DataFrame, labels: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The rows of ``docs`` whose probability of the highest grade reaches ``plan.accept``."""
    names = tuple(fresh(docs, *RATED))
    rated = rate(docs, learn(docs, graded(labels), plan), plan.accept, names=names)
    return rated.where(names[2]).drop(*names)


def digests(docs: DataFrame, labels: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """doc_id, expected_grade, tail_probability and kept."""
    model = learn(docs, graded(labels), plan)
    return rate(docs.select("doc_id", "text"), model, plan.accept).drop("text")
