"""Word shares of sources beside plain counting, and the sort of pointers beside Python's."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from check_oracles import connect, duck_rows, spark_rows

from quadloom.llm import divergence
from quadloom.llm.queries import ORACLES, QUERIES

UNIT = 1_000_000_000


def words(text):
    lower = lambda m: m.group().lower()
    return re.findall(divergence.WORD, re.sub("[A-Z]", lower, text or ""))


def expected(rows, least=3, most=200):
    """All rows of the audit of (text, lang, source), by plain loops."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = Counter(words(text))
        counts[lang, source] += found
        docs[lang].update(found.keys())
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + UNIT * (count[t] + 1) // (total + len(kept)) for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        of = {s: shares(counts[lang, s]) for s in sources}
        gain = lambda p, q: (p - q) * (p - q) // q
        for s in sources:
            pairs = [(o, sum(gain(of[s][t], of[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, gain(of[s][t], whole[t])) for t in kept if counts[lang, s][t] and of[s][t] > whole[t]]
            for part, items, top in (("pair", pairs, None), ("term", terms, most)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:top]
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_sorted_runs():
    random.seed(1)
    stems = ["a", "ab", "abcdefgh", "abcdefghi", "abcdefghabcdefgh", "é", "漢字", "x" * 300, "x" * 300 + "y", "x" * 299 + "z", "q" * 8]
    texts = [" ".join(random.choices(stems, k=random.randrange(9))) for _ in range(200)]
    joined = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    data = divergence._LOWER[np.frombuffer(joined, np.uint8)]
    starts, lengths, doc = divergence.pointers(data, offsets)
    found = [joined[s : s + n].decode() for s, n in zip(starts, lengths, strict=True)]
    assert found == [w for t in texts for w in t.split()]
    assert doc.tolist() == [i for i, t in enumerate(texts) for _ in t.split()]
    shard = doc % 3
    order, runs = divergence.sorted_runs(data, starts, lengths, shard)
    wanted = sorted(range(len(found)), key=lambda i: (shard[i], found[i].encode(), i))
    assert order.tolist() == wanted
    keys = [(shard[i], found[i]) for i in wanted]
    assert runs.tolist() == [i for i, k in enumerate(keys) if not i or k != keys[i - 1]]


def test_words_end_with_their_document():
    part = pa.record_batch([["en"] * 4, ["a"] * 4, ["one", "", "two", None]], names=["lang", "source", "text"])
    found = divergence.count_runs(part).to_pylist()
    assert [(r["term"], r["count"], r["docs"]) for r in found] == [("one", 1, 1), ("two", 1, 1)]


ROWS = [
    ("The cat saw the Cat, über ÜBER.", "en", "a"),
    ("The cat saw the Cat, über ÜBER.", "en", "a"),
    ("the dog: cat_cat cat", "en", "b"),
    ("THE END", "en", None),
    ("", "en", "c"),
    (None, "en", "d"),
    ("12 34 _ \x7f\x00", "en", "e"),
    ("nur einmal", "de", "a"),
    ("nur zweimal", "de", "b"),
    (None, None, None),
    ("x" * 400 + " lone", None, "a"),
    ("x" * 400 + " lone", "", "b"),
    ("x" * 400 + "y " + "x" * 400, None, "b"),
    ("lone", None, "c"),
]


@pytest.mark.parametrize("size", [divergence.SLICE, 40])
def test_edges(spark, monkeypatch, size):
    monkeypatch.setattr(divergence, "SLICE", size)
    rows = [(*r, *["z"] * 5) for r in ROWS]
    clash = "text string, lang string, source string, term string, p string, Count string, g string, item string"
    df = spark.createDataFrame(rows, clash).repartition(3)
    assert got(divergence.audit(df)) == expected(ROWS)
    assert got(divergence.audit(df, 1, 2)) == expected(ROWS, 1, 2)
    assert divergence.audit(df.where("false")).count() == 0


def test_made_sources(spark):
    """Sources of very different sizes, one with a third of all words, and counts of many kinds."""
    random.seed(3)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{'long' * (i % 4)}" for i in range(300)]
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else f"s{i % 11}"
        own = vocabulary[(sum(map(ord, source)) % 7) :: 2] if i % 5 else vocabulary
        rows.append((" ".join(random.choices(own, k=60)), "en" if i % 4 else "fr", source))
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert got(divergence.audit(df)) == expected(rows)


def test_sql(spark):
    con = connect("/root/testdata/sf0.001")
    found = spark_rows(QUERIES["op11_source_divergence"](spark, "/root/testdata/sf0.001"))
    assert found == duck_rows(con, ORACLES["op11_source_divergence"])
