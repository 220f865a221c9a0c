"""Helpers of the operators on texts: Arrow batches by bytes, checkpoints, chunks between spaces."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quadloom.session import work_folder

# Bytes of text that a Python worker takes up at a time.
SLICE_BYTES = 2 << 20


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` cut so that each cut holds about ``most`` bytes of ``column``, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    cut = np.cumsum(lengths, dtype=np.int64) // most
    edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written below the shared work folder and read again, which cuts its lineage."""
    spark = df.sparkSession
    path = work_folder(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_{uuid.uuid4().hex[:8]}"
        taken.add(name.lower())
        found.append(name)
    return found


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tidy() -> None:
    """Give memory back that nothing uses: workers outlive their tasks, and beside them others work."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps what it has
        pass


Batches = Iterator[pa.RecordBatch]


def in_arrow(df: DataFrame, run: Callable[[Batches], Batches], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` that leaves a tidy worker."""

    def tidied(batches: Batches) -> Batches:
        yield from run(batches)
        tidy()

    return df.mapInArrow(tidied, schema)


_HELD: dict[tuple, object] = {}


def held(family: str, load: Callable, *args):
    """``load(*args)``, kept by this worker until something of another family is asked for."""
    key = (family, load.__qualname__, *args)
    if key not in _HELD:
        for other in [k for k in _HELD if k[0] != family]:
            del _HELD[other]
        tidy()
        _HELD[key] = load(*args)
    return _HELD[key]


def on_slices(
    df: DataFrame,
    column: str,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str | StructType,
    most: int = SLICE_BYTES,
) -> DataFrame:
    """``make()`` once in each task; its result on every cut of every Arrow batch.

    Workers outlive their tasks, so Arrow gives back what it holds after each batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            for part in slices(batch, column, most):
                yield one(part)
            pa.default_memory_pool().release_unused()

    return in_arrow(df, run, schema)


def chunked(texts: pa.Array, joined: str, split: Callable[[str], list[str]]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Texts as chunks that a tokenizer treats one by one: offsets by text, code of each chunk, distinct chunks.

    A chunk is a word with the one space before it. Texts that match the
    pattern ``joined`` have spaces that a tokenizer may take together with
    their neighbours; those are cut by ``split``. The first chunk of a text has
    no space before it. Empty texts have no chunks.
    """
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, pattern=joined).to_numpy(zero_copy_only=False)
    words = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), pattern=" ")
    offsets = words.offsets.to_numpy().astype(np.int64)
    flat = words.flatten().dictionary_encode()
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = flat.dictionary.to_pylist()
    first = offsets[:-1]  # a split text has one word at least
    heads, at_head = np.unique(codes[first], return_inverse=True)
    codes[first] = len(names) + at_head
    chunks = [f" {w}" for w in names] + [names[i] for i in heads]
    counts = np.diff(offsets)
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    drop = odd | empty
    if drop.any():
        keep = np.ones(len(codes), bool)
        keep[first[drop]] = False
        codes, counts = codes[keep], np.where(drop, 0, counts)
    if odd.any():
        known = {c: i for i, c in enumerate(chunks)}
        more: dict[int, np.ndarray] = {}
        for i in np.flatnonzero(odd):
            own = split(texts[int(i)].as_py())
            more[int(i)] = np.fromiter((known.setdefault(c, len(known)) for c in own), np.int64, len(own))
        chunks = list(known)
        parts, edges, done = [], np.concatenate([[0], np.cumsum(counts)]), 0
        for i, own in more.items():
            parts += [codes[done : edges[i]], own]
            done = edges[i]
            counts[i] = len(own)
        codes = np.concatenate([*parts, codes[done:]])
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), codes, chunks


class Known(dict):
    """Results by key, computed when first asked for.

    Holds ``most`` of them at most: when half of that are new, those not asked
    for since the last time are forgotten.
    """

    def __init__(self, compute: Callable | None = None, most: int = 200_000):
        super().__init__()
        self.compute, self.half, self.old = compute, most // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def peek(self, key):
        """The result if it is held, else None."""
        value = self.get(key)
        return self.old.get(key) if value is None else value

    def add(self, results: dict) -> None:
        """Take results that were computed elsewhere."""
        if len(self) + len(results) > self.half:
            self.old = dict(self)
            self.clear()
        self.update(results)


def lists(values: list[bytes], codes: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """For each text the int32 lists of its chunks, joined; ``values`` has the bytes of each distinct chunk's list."""
    bounds = np.zeros(len(values) + 1, np.int32)
    np.cumsum(np.fromiter(map(len, values), np.int64, len(values)) // 4, out=bounds[1:])
    own = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join(values), np.int32)))
    taken = own.take(pa.array(codes))
    ends = np.concatenate([[0], np.cumsum(np.diff(bounds)[codes], dtype=np.int64)])[offsets]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), taken.flatten())
