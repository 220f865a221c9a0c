"""How the words of one source differ from those of others in its language.

``audit`` compares smoothed word frequencies of sources. Words are found by a
sort of pointers: in a slice of an Arrow buffer every start of a word is a
pointer into the bytes. Multikey quicksort orders them, eight bytes at a time:
pointers with equal bytes so far form a run, and a run is sorted by the next
eight bytes, all runs of a level at once. Words that are equal end up in one
run, in the order of their documents, so a run gives the word's occurrences
and, by its changes of document, its document frequency, for each source.

Runs are summed by (language, word) in one shuffle; a key has one row per slice
and source at most. A pair of sources is compared over all kept words without
a row per pair and word: words that one of the two lacks depend on the count in
the other alone, of which there are few different ones; words that both have
are compared word by word, in tasks that send one sum per pair of sources.

Defined cases: null text, language and source are empty strings; a row is a
document of its own, repeated or not; a source without words is compared like
any other; a language without kept words has pairs of value 0; ties sort by the
bytes of the item; extra columns are left out; an empty table gives no rows.
Numbers are whole: products that may exceed 64 bits are decimals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadloom.llm.common import checkpointed, slices

SLICE = 16 << 20  # bytes of text in one sort
WORD = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_UNIT = 1_000_000_000
_DEEP = 256  # from here on runs are few, and whole words are compared
RUNS = "lang string, source string, term string, count long, docs long"

_LOWER = np.zeros(256, np.uint8)  # a letter in lower case, 0 for what separates words
_LOWER[128:] = np.arange(128, 256)
for _c in range(ord("a"), ord("z") + 1):
    _LOWER[_c] = _LOWER[_c - 32] = _c
_MASKS = np.array([0xFFFFFFFFFFFFFFFF << (64 - 8 * n) & 0xFFFFFFFFFFFFFFFF for n in range(9)], np.uint64)


def pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words of ``data`` (letters, or 0 between words) start, how long they are, and in which document."""
    letter = data != 0
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]  # of the next document, if it isn't empty
    first[edges] = letter[edges]
    inner = edges[edges > 0]
    last[inner - 1] = letter[inner - 1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    return starts, lengths, np.searchsorted(offsets, starts, "right") - 1


def _chunk(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes of words from ``depth`` on as numbers that sort like them."""
    rest = np.clip(lengths - depth, 0, 8)
    at = np.where(rest > 0, starts + depth, 0)
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[at]
    return np.ascontiguousarray(eight).view(">u8").ravel().astype(np.uint64) & _MASKS[rest]


def _small(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 in the narrowest type, which numpy sorts fastest."""
    most = int(values.max(initial=0))
    return values.astype(np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def sorted_runs(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, shard: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The order of words by shard and bytes, equal ones as they come, and where each run of equals starts."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = _chunk(padded, starts, lengths, 0)
    order = np.argsort(key, kind="stable")
    order = order[np.argsort(_small(shard[order]), kind="stable")]
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (shard[order][1:] != shard[order][:-1])
    depth = 8
    while True:
        # pointers of runs that have words that go on
        run = np.cumsum(new) - 1
        size = np.bincount(run, minlength=1)
        goes_on = np.zeros(len(size), bool)
        goes_on[run[lengths[order] > depth]] = True
        open_ = np.flatnonzero((goes_on & (size > 1))[run])
        if not len(open_):
            return order, np.flatnonzero(new)
        own, group = order[open_], run[open_]
        if depth < _DEEP:
            key = _chunk(padded, starts[own], lengths[own], depth)
        else:
            words = [data[s : s + n].tobytes() for s, n in zip(starts[own].tolist(), lengths[own].tolist(), strict=True)]
            number = {w: i for i, w in enumerate(sorted(set(words)))}
            key = np.array([number[w] for w in words], np.uint64)
        again = np.argsort(key, kind="stable")
        again = again[np.argsort(_small(group[again] - group[0]), kind="stable")]
        order[open_] = own[again]
        key, group = key[again], group[again]
        changed = np.ones(len(key), bool)
        changed[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        new[open_] = changed
        if depth >= _DEEP:
            return order, np.flatnonzero(new)
        depth += 8


def _texts(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The words at some pointers."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    buffers = [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data[at].tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(starts), buffers).cast(pa.string())


def count_runs(part: pa.RecordBatch) -> pa.RecordBatch:
    """Occurrences and documents of every word of a slice, for each language and source."""
    groups = [part.column(c).dictionary_encode() for c in ("lang", "source")]
    langs, sources = (g.indices.to_numpy(zero_copy_only=False).astype(np.int64) for g in groups)
    pairs, shard_of_doc = np.unique(langs << 32 | sources, return_inverse=True)
    text = part.column("text").cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    data, offsets = _LOWER[raw], offsets - offsets[0]
    starts, lengths, doc = pointers(data, offsets)
    order, runs = sorted_runs(data, starts, lengths, shard_of_doc[doc])
    docs = doc[order]
    changed = np.ones(len(order), bool)
    changed[1:] = docs[1:] != docs[:-1]
    changed[runs] = True
    if len(runs):
        counts = np.diff(np.append(runs, len(order)))
        doc_counts = np.add.reduceat(changed.astype(np.int64), runs)
    else:
        counts = doc_counts = np.zeros(0, np.int64)
    first = order[runs]
    pair = pairs[shard_of_doc[doc[first]]] if len(first) else np.zeros(0, np.int64)
    columns = [
        groups[0].dictionary.take(pa.array(pair >> 32)),
        groups[1].dictionary.take(pa.array(pair & 0xFFFFFFFF)),
        _texts(data, starts[first], lengths[first]),
        pa.array(counts.astype(np.int64)),
        pa.array(doc_counts),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RUNS.split(", ")])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count and docs of each slice; rows of one key are to be summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def sort() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return count_runs(whole)

        for batch in batches:
            for part in slices(batch, "text", SLICE):
                if held and size + part.nbytes > SLICE:
                    yield sort()
                    held, size = [], 0
                held.append(part)
                size += part.nbytes
        if held:
            yield sort()
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, RUNS)


def _plain(docs: DataFrame) -> DataFrame:
    empty = F.lit("")
    return docs.select(*(F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")))


def kept_terms(plain: DataFrame, least_docs: int) -> DataFrame:
    """lang, term, source, count and lang_count of terms in at least ``least_docs`` documents of their language."""
    # one shuffle: by (lang, term) the sums by source are in place, too
    runs = term_counts(plain).repartition("lang", "term")
    by_source = runs.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    # one row a source in a list
    terms = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("lang_count"), F.collect_list(F.struct("source", "count")).alias("own")
    )
    kept = terms.where(F.col("docs") >= least_docs)
    return kept.select("lang", "term", "lang_count", F.inline("own")).select("lang", "term", "source", "count", "lang_count")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of ``count`` in units of 10^-9, above 0."""
    wide = (count + 1).cast("decimal(20,0)") * F.lit(_UNIT).cast("decimal(10,0)")
    return (1 + F.call_function("div", wide, (total + terms).cast("decimal(20,0)"))).cast("long")


def _gain(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q): shares are below 2^30, so squares fit in 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _common(shares: DataFrame) -> DataFrame:
    """For words that two sources have: the sum of what comparing them adds to comparing each with a missing word."""

    def gain(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], int] = {}

        def out() -> pa.RecordBatch:
            pairs = pa.array([k[0] for k in held], pa.int64()), pa.array([k[1] for k in held], pa.int64())
            values = pa.array(list(held.values()), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([*pairs, values], names=["g", "h", "more"])

        for batch in batches:
            column = batch.column("own")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            flat = column.flatten()
            g, p, p0 = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("g", "p", "p0"))
            # pairs of a slice of words at a time
            squares = np.cumsum(sizes * sizes)
            edges = [0, *(np.flatnonzero(np.diff(squares >> 20)) + 1).tolist(), len(sizes)]
            for a, b in zip(edges, edges[1:], strict=False):
                n = sizes[a:b]
                left = np.repeat(np.arange(ends[a] - sizes[a], ends[b - 1]) if b > a else np.zeros(0, np.int64), np.repeat(n, n))
                inside = np.arange(len(left)) - np.repeat(np.cumsum(n * n) - n * n, n * n)
                right = np.repeat(ends[a:b] - n, n * n) + inside % np.repeat(n, n * n)
                two = left != right
                left, right = left[two], right[two]
                more = gain(p[left], p[right]) - gain(p[left], p0[right]) - gain(p0[left], p[right]) + gain(p0[left], p0[right])
                order = np.lexsort((g[right], g[left]))
                left, right, more = g[left][order], g[right][order], more[order]
                if len(more):
                    first = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
                    for x, y, s in zip(left[first].tolist(), right[first].tolist(), np.add.reduceat(more, first).tolist(), strict=True):
                        held[x, y] = held.get((x, y), 0) + s
                if len(held) > 1 << 18:
                    yield out()
        yield out()

    listed = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("g", "p", "p0")).alias("own")).where(F.size("own") > 1)
    return listed.select("own").mapInArrow(run, "g long, h long, more long").groupBy("g", "h").agg(F.sum("more").alias("more"))


def audit(docs: DataFrame, least_docs: int = 3, most_terms: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: other sources by divergence, and the terms that set a source apart."""
    plain = _plain(docs)
    kept = checkpointed(kept_terms(plain, least_docs))
    by_lang = kept.groupBy("lang", "term").agg(F.max("lang_count").alias("n")).groupBy("lang")
    langs = by_lang.agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    sums = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count("*").alias("own_terms"))
    # one row per language and source that occurs
    groups = plain.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    number = F.xxhash64("lang", "source")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "own_terms", "terms", "lang_total")}
    groups = groups.select("lang", "source", number.alias("g"), *zero.values())
    p0 = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms")))
    groups = checkpointed(groups.withColumn("p0", p0))
    if groups.count() != groups.select("g").distinct().count():
        raise ValueError("two sources have one hash")

    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "g", "count", "p0",
        _share(F.col("count"), F.col("total"), F.col("terms")).alias("p"),
        _share(F.col("lang_count"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    shares = checkpointed(shares)

    best = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), _gain(F.col("p"), F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    terms = best.withColumn("rank", place).where(F.col("rank") <= most_terms).withColumn("part", F.lit("term"))

    # words that the other lacks, by their share: few different ones
    spread = shares.groupBy("g", "p").agg(F.count("*").alias("n"))
    a, b = groups.alias("a"), groups.alias("b")
    pairs = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source")))
    pairs = pairs.select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item"),
        F.col("a.g").alias("g"), F.col("b.g").alias("h"), F.col("a.p0").alias("p0"), F.col("b.p0").alias("q0"),
        (F.col("a.terms") - F.col("a.own_terms") - F.col("b.own_terms")).alias("neither"),
    )
    wide = "decimal(38,0)"
    sides = [
        pairs.join(spread, "g").groupBy("g", "h").agg(F.sum(_gain(F.col("p"), F.col("q0")).cast(wide) * F.col("n")).alias("left")),
        pairs.join(spread.withColumnRenamed("g", "h"), "h").groupBy("g", "h").agg(
            F.sum(_gain(F.col("p0"), F.col("p")).cast(wide) * F.col("n")).alias("right")
        ),
        _common(shares),
    ]
    for side in sides:
        pairs = pairs.join(side, ["g", "h"], "left")
    alike = _gain(F.col("p0"), F.col("q0")).cast(wide) * F.col("neither")
    value = sum((F.coalesce(F.col(c).cast(wide), F.lit(0).cast(wide)) for c in ("left", "right", "more")), F.coalesce(alike, F.lit(0).cast(wide)))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    others = pairs.select("lang", "source", "item", value.cast("long").alias("value")).withColumn("rank", place)
    others = others.withColumn("part", F.lit("pair"))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return others.select(names).unionByName(terms.select(names))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3
), own AS (
  SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT DISTINCT lang, source FROM d
), lang_sums AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY ALL
), sums AS (
  SELECT g.lang, g.source, coalesce(sum(own.n), 0) AS total FROM g LEFT JOIN own USING (lang, source) GROUP BY ALL
), q AS (
  SELECT kept.lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 1) // (total + v) AS q FROM kept JOIN lang_sums USING (lang)
), p AS (
  SELECT sums.lang, sums.source, kept.term, coalesce(own.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(own.n, 0) + 1) // (sums.total + v) AS p
  FROM sums JOIN lang_sums USING (lang) JOIN kept USING (lang) LEFT JOIN own USING (lang, source, term)
), pair AS (
  SELECT a.lang, a.source, b.source AS item,
    coalesce(sum((a.p - b.p) * (a.p - b.p) // b.p), 0) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, b.source, 0 FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  WHERE a.lang NOT IN (SELECT lang FROM kept)
), term AS (
  SELECT p.lang, source, p.term AS item, (p - q) * (p - q) // q AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q
), ranked AS (
  SELECT 'pair' AS part, lang, source, item, value FROM pair UNION ALL SELECT 'term', lang, source, item, value FROM term
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 200
"""
