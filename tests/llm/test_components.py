"""One document of each component of fingerprints, beside a plain search."""

import random

from quadloom.llm import simhash


def kept(docs, words=4, radius=4):
    """Rows that stay of (doc_id, text), by plain comparison of all fingerprints."""
    prints = [simhash.fingerprint(simhash.shingle_hashes(t, words)) for _, t in docs]
    mask = (1 << 64) - 1
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if ((prints[i] ^ prints[j]) & mask).bit_count() <= radius and label[i] != label[j]:
                old = label[i]
                label = [label[j] if x == old else x for x in label]
    stay = {}
    for (doc_id, text), x in zip(docs, label, strict=True):
        if doc_id is not None and (x not in stay or doc_id < stay[x]):
            stay[x] = doc_id
    return sorted(stay.values())


def test_one_document_of_each_component(spark):
    random.seed(6)
    words = [f"w{i}" for i in range(500)]
    docs = []
    for base in range(60):
        text = random.choices(words, k=random.choice([3, 30, 300, 900]))
        docs.append((1000 - base, " ".join(text)))
        for copy in range(random.randrange(4)):
            near = list(text)
            for _ in range(copy):
                near[random.randrange(len(near))] = "other"
            docs.append((2000 + 10 * base + copy, " ".join(near)))
    docs += [(5, ""), (6, None), (7, " \n"), (1, "the same"), (1, "the same"), (1, "another of its id")]
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, d string, H string").repartition(4)
    left = simhash.one_of_component(frame)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == kept([d for d in docs])
    found = {(r.doc_id, r.component_id) for r in simhash.near_copies(frame).collect()}
    assert {c for _, c in found} == set(kept(docs))


def test_edges(spark, edges, no_rows):
    left = simhash.one_of_component(edges)
    assert simhash.one_of_component(no_rows).count() == 0
    assert left.where("doc_id is null").count() == 1
    assert left.where("doc_id = 5").count() == 1 and left.where("doc_id = 6").count() == 0
    texts = [r.text for r in left.where("doc_id = 1").collect()]
    assert len(texts) == len(set(texts)) == 2


def test_many_rows_of_one_document_cost_no_square(spark):
    """Five thousand rows of one text and id, or of one text without id, beside as many ids: about the same work."""
    import time

    from quadloom.llm import substrings

    text = " ".join(f"word{i}" for i in range(300)) + " " + " ".join(f"again{i % 20}" for i in range(200))
    rows = spark.range(5_000)
    took = {}
    for name, doc_id in (("ids", "id"), ("one", "cast(7 as long)"), ("none", "cast(null as long)")):
        docs = rows.selectExpr(f"{doc_id} as doc_id").selectExpr("doc_id", f"'{text}' as text")
        start = time.time()
        found = substrings.digests(docs).groupBy("n_removed").count().collect()
        took[name] = time.time() - start
        assert sum(r["count"] for r in found) == 5_000
        if name == "ids":  # all but the first go whole
            assert {r["count"] for r in found if r.n_removed == len(text)} == {4_999}
        else:  # rows of one document have one result
            assert len(found) == 1 and 0 < found[0].n_removed < len(text)
    assert max(took.values()) < 60
