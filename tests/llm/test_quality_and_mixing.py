import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from check_oracles import connect, duck_rows, spark_rows
from quadloom.llm import mixing, quality, queries, repetition

SF = "/root/testdata/sf0.001"
WORD = "[^\x20\x09-\x0d]+"


def brute_measures(text, min_words=10):
    text = text or ""
    words = re.findall(WORD, text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        again += bool(re.search(WORD, line)) and line in seen
        seen.add(line)
    longest = [0] * len(words)
    places = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    for own in places.values():
        for i in own:
            for j in own:
                if i != j:
                    k = 0
                    while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                        k += 1
                    longest[i] = max(longest[i], k)
    covered = {i + k for i, n in enumerate(longest) if n >= min_words for k in range(n)}
    signs = len(re.findall(r"[#*$%&|<>]", text))
    return [len(words), sum(map(len, words)), signs, again, len(repeated), len(covered), max(longest, default=0)]


def test_measures_are_brute_force():
    random.seed(3)
    signs = ["a", "b", "é", " ", " ", "\n", "\t", "\x0b", "\x1c", "|", "  "]
    texts = ["".join(random.choice(signs) for _ in range(random.randint(0, 90))) for _ in range(400)]
    texts += [None, "", "a " * 50, "\n\n", "x y z w q r t u v m n " * 6]
    got = np.array(repetition.measures(pa.array(texts, pa.string()), 10)).T.tolist()
    assert got == [brute_measures(t) for t in texts]


def test_query_of_repetition(spark, edges, no_rows):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op4_repetition(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        if len(docs[r.doc_id]) > 6000:
            continue  # slow by brute force
        n, chars, signs, lines, repeated, covered, longest = brute_measures(docs[r.doc_id])
        failed = n < 50 or 100 * repeated > 50 * n
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, signs, lines, repeated)
        assert r.base_failed == failed and r.kept == (not failed and covered <= 0.3 * n and longest <= 100)
    kept = {(r.doc_id, r.kept) for r in repetition.judged(edges).collect()}
    assert (2, False) in kept and (5, False) in kept and len(kept) == 8
    assert repetition.measure(edges).count() == edges.count() and repetition.judged(no_rows).count() == 0


def graded_sample(sf):
    docs, labels = (f"'{sf}/{t}.parquet'" for t in ("documents", "labels"))
    return duckdb.sql(
        f"SELECT text, CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 ELSE 2 END FROM {docs} JOIN {labels} USING (doc_id) ORDER BY hash(doc_id)"
    ).fetchall()


def test_held_out_accuracy():
    rows = graded_sample("/root/testdata/sf0.1")
    plan, n = quality.Plan(), len(rows) * 3 // 4
    owner, bucket = quality.features(pa.array([t for t, _ in rows]), plan.buckets)
    pairs = np.unique(owner * plan.buckets + bucket)
    ends = np.searchsorted(pairs // plan.buckets, np.arange(len(rows) + 1))
    lists = [pairs[a:b] % plan.buckets for a, b in zip(ends, ends[1:], strict=False)]
    grades = np.array([g for _, g in rows])
    model = quality.fit(lists[:n], grades[:n], plan)
    assert (np.diff(model.thresholds) > 0).all()
    above = quality.tails(quality.score(model, pa.array([t for t, _ in rows[n:]])), model.thresholds)
    kept, held = above[:, -1] >= plan.accept, grades[n:]
    assert kept[held == 2].mean() > 0.98 and kept[held == 0].mean() < 0.15 and kept[held == 1].mean() < 0.25
    order = np.argsort(above.sum(axis=1))
    assert held[order[: len(order) // 10]].mean() < held[order[-len(order) // 10 :]].mean() - 0.9


def test_quality_of_edges(spark, edges, no_rows):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 1, 1), (9, 1, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    assert quality.digests(edges, labels).count() == edges.count()
    none = labels.where("false")
    rows = quality.digests(edges, none).collect()
    assert len({r.tail_probability for r in rows}) == 1 and rows[0].expected_grade == pytest.approx(1)
    assert quality.digests(no_rows, none).count() == 0
    assert quality.accepted(edges, labels).columns == edges.columns
    assert {r.grade for r in quality.graded(labels).collect()} == {0, 1, 2, None}


def test_query_of_quality(spark):
    rows = queries.op6_ordinal_quality(spark, SF).collect()
    assert len(rows) == 200 and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows)


def test_query_of_mixing(spark):
    got = spark_rows(queries.op3_raked_mixing(spark, SF))
    assert got == duck_rows(connect(SF), queries.ORACLES["op3_raked_mixing"])


def test_raking_meets_its_targets(spark):
    cells = spark.createDataFrame([("a", "x", "p", 10.0), ("a", "y", "p", 30.0), ("b", "x", "q", 40.0), ("b", "y", "p", 5.0), ("b", "y", "q", 0.0)], "source string, lang string, topic string, tokens double")
    plan = mixing.Plan(targets={"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.6, "y": 0.4}, "topic": {"p": 0.7, "q": 0.3}}, turns=60, rate=0.5)
    rows = mixing.calibrated(mixing.rake(cells, plan), plan).collect()
    total = sum(r.weight for r in rows)
    for d, shares in plan.targets.items():
        for value, share in shares.items():
            assert sum(r.weight for r in rows if r[d] == value) / total == pytest.approx(share, abs=1e-3)
    assert sum(r.tokens * r.probability for r in rows) == pytest.approx(0.5 * 85, rel=1e-6)
    assert all(0 <= r.probability <= 1 for r in rows)


@pytest.mark.parametrize("rate", [0.5, 0.8])
def test_caps_and_targets_are_met_together(spark, rate):
    """Plain raking at rate 0.8 asks for more of a cell than there is; other weights meet the same targets."""
    cells = [("a", "x", "p", 30.0), ("a", "y", "p", 20.0), ("b", "x", "p", 20.0), ("b", "y", "p", 30.0)]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, tokens double")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.6, "y": 0.4}, "topic": {"p": 1.0}}
    plan = mixing.Plan(targets=targets, rate=rate)
    plain = {(r.source, r.lang): r.weight * rate / r.tokens for r in mixing.rake(frame, plan).collect()}
    assert (max(plain.values()) > 1) == (rate == 0.8)
    rows = mixing.calibrated(mixing.rake(frame, plan, capped=True), plan).collect()
    taken = {(r.source, r.lang): r.tokens * r.probability for r in rows}
    assert all(r.probability <= 1 for r in rows) and sum(taken.values()) == pytest.approx(100 * rate, rel=1e-6)
    for i, d in enumerate(("source", "lang")):
        for value, share in targets[d].items():
            assert sum(n for k, n in taken.items() if k[i] == value) / sum(taken.values()) == pytest.approx(share, abs=1e-3)


def test_margins_report_what_is_reached(spark):
    docs = spark.createDataFrame([(i, "word " * 300, "en" if i % 4 else "fr", f"s{i % 3}") for i in range(120)], "doc_id long, text string, lang string, source string")
    plan = mixing.Plan(rate=0.5, targets={"lang": {"en": 0.6, "fr": 0.4}})
    found = {(r.dimension, r.value): r for r in mixing.margins(mixing.sampled(docs, plan), plan).collect()}
    assert found["lang", "fr"].own == pytest.approx(0.25) and found["lang", "fr"].target == pytest.approx(0.4)
    assert all(r.reached == pytest.approx(r.target, abs=1e-3) for r in found.values())
    most = mixing.Plan(rate=0.95, targets={"lang": {"en": 0.6, "fr": 0.4}})
    reached = {(r.dimension, r.value): r.reached for r in mixing.margins(mixing.sampled(docs, most), most).collect()}
    assert reached["lang", "fr"] == pytest.approx(0.25 / 0.95, abs=1e-3)  # all there is


def test_mixing_of_edges(spark, edges, no_rows):
    found = mixing.sampled(edges).collect()
    assert len(found) == edges.count() and {r.lang for r in found} == {"en", "de", mixing.NONE}
    assert len({r.selected for r in found if r.doc_id == 1 and r.probability in (0.0, 1.0)}) <= 1
    assert mixing.sampled(no_rows).count() == 0 and mixing.mixed(no_rows).count() == 0
    assert mixing.mixed(edges, mixing.Plan(rate=1.0)).columns == edges.columns
    plan = mixing.mixed(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
