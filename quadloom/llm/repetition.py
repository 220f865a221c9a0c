"""Quality rules on repetition, by a suffix array over the words of each text.

Texts of a batch are sorted together: the first key of a word is its document,
so suffixes of different documents never match. Prefix doubling sorts them, and
the ranks it passes through give the longest common prefix of neighbours. The
longest repeat that starts at a word is the longer of its two common prefixes;
the union of these spans, the maximal repeated strings of words, is what a text
repeats. A text is kept if it passes the base rules, repeats of ``min_words``
or more cover at most ``max_covered`` of its words, and its longest repeat has
at most ``max_longest`` words.

Defined cases: a null or empty text has no words and fails the base rules;
texts are measured whole; rows, repeated or not, and extra columns pass
unchanged; columns that have the names of the results are replaced; an empty
table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quadloom.llm.common import on_slices

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat",
]


@dataclass(frozen=True)
class Limits:
    min_words: int = 10
    max_covered: float = 0.3
    max_longest: int = 100


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of texts without nulls: offsets by text, code of each word, distinct words."""
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten().dictionary_encode()
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = (pc.binary_length(flat.dictionary).to_numpy(zero_copy_only=False) > 0)[codes]
    offsets = np.concatenate([[0], np.cumsum(real)])[split.offsets.to_numpy()]
    return offsets, codes[real], flat.dictionary


def _longest_repeats(owner: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest string from it that its text has from another word too."""
    n = len(codes)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    _, ranks = np.unique(owner * (int(codes.max()) + 1) + codes, return_inverse=True)
    # a rank is the number of smaller suffixes, equal for those not told apart yet
    sizes = np.bincount(ranks)
    ranks = (np.cumsum(sizes) - sizes)[ranks]
    levels = [np.append(ranks, -1)]
    active = np.flatnonzero(np.bincount(ranks, minlength=n)[ranks] > 1)
    k = 1
    while len(active):
        ahead = np.minimum(active + k, n)
        now, then = levels[-1][active], levels[-1][ahead]
        key = now * (n + 1) + then + 1
        order = np.argsort(key, kind="stable")
        key, active = key[order], active[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.concatenate([[True], now[order][1:] != now[order][:-1]])
        at = np.arange(len(key))
        within = np.maximum.accumulate(np.where(first, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        ranks = levels[-1].copy()
        ranks[active] = now[order] + within
        levels.append(ranks)
        alone = first & np.concatenate([first[1:], [True]])
        active = active[~alone]
        k *= 2
    sorted_at = np.empty(n, np.int64)
    sorted_at[levels[-1][:-1]] = np.arange(n)
    a, b = sorted_at[:-1], sorted_at[1:]
    # only neighbours that share a word
    shared = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[shared], b[shared]
    common = np.zeros(len(a), np.int64)
    for i in range(len(levels) - 1, -1, -1):
        x, y = np.minimum(a + common, n), np.minimum(b + common, n)
        same = (levels[i][x] == levels[i][y]) & (x < n) & (y < n)
        common[same] += 1 << i
    np.maximum.at(longest, a, common)
    np.maximum.at(longest, b, common)
    return longest


def _covered(lengths: np.ndarray, least: int) -> np.ndarray:
    """Which words are in a repeat of at least ``least`` words."""
    n = len(lengths)
    ends = np.where(lengths >= least, np.arange(n) + lengths, 0)
    return np.maximum.accumulate(ends) > np.arange(n) if n else np.zeros(0, bool)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[offsets])


def measures(texts: pa.Array, min_words: int) -> list[np.ndarray]:
    """The measures of texts, in the order of ``MEASURES``."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    offsets, codes, words = words_of(texts)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    symbols = pc.count_substring_regex(texts, pattern=r"[#*$%&|<>]").to_numpy(zero_copy_only=False)
    lines = pc.split_pattern(texts, pattern="\n")
    flat = lines.flatten().dictionary_encode()
    real = pc.match_substring_regex(flat.dictionary, pattern=r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    line = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line_ends = lines.offsets.to_numpy()
    again = np.ones(len(line), bool)
    again[np.unique(np.repeat(np.arange(n), np.diff(line_ends)) * len(real) + line, return_index=True)[1]] = False
    lengths = _longest_repeats(owner, codes)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, owner, lengths)
    # a window of three words that is found twice counts as a whole, and no more of it
    in_windows = _covered(np.where(lengths >= 3, 3, 0), 3)
    return [
        np.diff(offsets),
        _sums(chars, offsets),
        symbols,
        _sums(again & real[line], line_ends),
        _sums(in_windows, offsets),
        _sums(_covered(lengths, min_words), offsets),
        longest,
    ]


def measure(df: DataFrame, text: str = "text", min_words: int = Limits.min_words) -> DataFrame:
    """``df`` with the measures of its column ``text``."""
    kept = [f for f in df.schema if f.name.lower() not in MEASURES]
    names = [*(f.name for f in kept), *MEASURES]

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            own = [batch.column(i) for i, n in enumerate(batch.schema.names) if n.lower() not in MEASURES]
            found = measures(batch.column(text), min_words)
            return pa.RecordBatch.from_arrays([*own, *(pa.array(x.astype(np.int64)) for x in found)], names=names)

        return one

    return on_slices(df, text, make, StructType([*kept, *(StructField(n, LongType()) for n in MEASURES)]))


def judged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, the measures, base_failed and kept."""
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < 50) | (repeated * 100 > n * 50)
    fine = (F.col("covered_words") <= n * limits.max_covered) & (F.col("longest_repeat") <= limits.max_longest)
    found = measure(docs.select("doc_id", "text"), min_words=limits.min_words).drop("text")
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine)
