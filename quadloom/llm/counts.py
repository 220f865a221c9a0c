"""Token counts of byte-pair vocabularies without making ids.

``count_tokens`` counts what the vocabulary's library would give for each whole
text. A piece of text starts as a linked list of its bytes; a heap holds the
adjacent pairs that have a rank; the lowest-ranked, leftmost pair is merged
again and again. The count is the number of bytes less the number of merges.
Words repeat, so each task keeps the counts of the words it has seen, up to a
fixed number of them.

Defined cases: a null text is an empty one and has no bytes and no tokens;
special strings inside a text count as one token, as the library has them by
default; rows, repeated or not, and extra columns pass unchanged; columns that
have the names of the results are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quadloom.llm.common import SLICE_BYTES, Known, chunked, held, on_slices

# How byte-level vocabularies cut texts before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT = 1_000_000  # words whose counts a worker keeps
_WHITE = r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class Cutter:
    """Cuts texts into the words that a byte-level vocabulary merges by themselves."""

    def __init__(self, special: list[str]):
        if any(" " in s for s in special):
            raise ValueError("special strings must have no spaces")
        self.words = regex.compile(WORDS)
        self.special = frozenset(special)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        # spaces after white space belong to it, unless a word follows
        after = "|".join([_WHITE, r"\z", *(rf"\Q{s}\E" for s in special)])
        self.joined = f"{_WHITE} (?:{after})"

    def cut(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return self.words.findall(text)
        parts = self.specials.split(text)
        return [w for p in parts for w in ([p] if p in self.special else self.words.findall(p))]


class Merges:
    """The merges of a byte-pair vocabulary by rank."""

    def __init__(self, path: str, most: int = KEPT):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before, model = spec["pre_tokenizer"], spec["model"]
        plain = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        added = spec["added_tokens"]
        if spec["normalizer"] or not plain or model["type"] != "BPE" or model["ignore_merges"]:
            raise ValueError("the vocabulary must be of byte-level merges without changes to the text")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special strings must stand for themselves alone")
        self.cutter = Cutter([t["content"] for t in added])
        vocab = model["vocab"]
        self.first = [vocab[sign] for sign in byte_signs()]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.of_word = Known(self.count_word, most)

    def count_word(self, word: str) -> int:
        if word in self.cutter.special:
            return 1
        ids = [self.first[b] for b in word.encode()]
        size = n = len(ids)
        rank, made, push = self.rank.get, self.made, heapq.heappush
        # one number per pair: its rank, then its place
        bits = size.bit_length()
        places = (1 << bits) - 1
        heap, a = [], ids[0]
        for i in range(size - 1):
            b = ids[i + 1]
            if (r := rank(a << 32 | b)) is not None:
                heap.append(r << bits | i)
            a = b
        if not heap:
            return size
        heapq.heapify(heap)
        ids.append(-1)  # what is merged away, or past the end, makes no pair
        after, before = list(range(1, size + 1)), list(range(-1, size))
        while heap:
            pair = heapq.heappop(heap)
            i, r = pair & places, pair >> bits
            j = after[i]
            if ids[i] < 0 or rank(ids[i] << 32 | ids[j]) != r:
                continue
            a = made[r]
            ids[i], ids[j] = a, -1
            n -= 1
            after[i] = k = after[j]
            before[k] = i
            if (r := rank(a << 32 | ids[k])) is not None:
                push(heap, r << bits | i)
            h = before[i]
            if h >= 0 and (r := rank(ids[h] << 32 | a)) is not None:
                push(heap, r << bits | h)
        return n

    def count_chunk(self, chunk: str) -> int:
        return sum(map(self.of_word.__getitem__, self.cutter.cut(chunk)))


def byte_signs() -> list[str]:
    """The sign of each byte in byte-level vocabularies: itself where it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    place = {b: b for b in prints} | {b: 256 + n for n, b in enumerate(others)}
    return [chr(place[b]) for b in range(256)]


def load(path: str, most: int = KEPT) -> tuple[Merges, Known]:
    return held("counts", _load, path, most)


def _load(path: str, most: int) -> tuple[Merges, Known]:
    merges = Merges(path, most)
    return merges, Known(merges.count_chunk, most)


def count_tokens(
    df: DataFrame,
    vocabulary: str,
    text: str = "text",
    n_tokens: str = "n_tokens",
    slice_bytes: int = 4 * SLICE_BYTES,
    most: int = KEPT,
) -> DataFrame:
    """``df`` with the number of tokens of its column ``text``.

    A worker takes up ``slice_bytes`` of text at a time and keeps the counts of
    ``most`` words: more of both is faster and takes more memory.
    """
    kept = [f for f in df.schema if f.name.lower() != n_tokens.lower()]
    names = [*(f.name for f in kept), n_tokens]

    def make():
        merges, known = load(vocabulary, most)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            offsets, codes, chunks = chunked(batch.column(text), merges.cutter.joined, merges.cutter.cut)
            each = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
            sums = np.concatenate([[0], np.cumsum(each[codes])])
            own = [batch.column(i) for i, n in enumerate(batch.schema.names) if n.lower() != n_tokens.lower()]
            return pa.RecordBatch.from_arrays([*own, pa.array(np.diff(sums[offsets]))], names=names)

        return one

    return on_slices(df, text, make, StructType([*kept, StructField(n_tokens, LongType())]), slice_bytes)


def over_limits(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit: whether a text has more than ``limit`` tokens."""
    counted = count_tokens(docs.select("doc_id", "text"), vocabulary)
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
