import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quadloom.llm import components, queries, simhash, substrings, suffixes

SF = "/root/testdata/sf0.001"
LEAST = -(1 << 63)


# Suffix sorting ---------------------------------------------------------------


def test_suffixes_sort_as_their_bytes():
    rng = np.random.default_rng(0)
    for letters in (2, 1):
        raw = rng.integers(97, 97 + letters, 3000).astype(np.uint8)
        starts, group = rng.integers(0, 2900, 500), np.sort(rng.integers(0, 20, 500))
        order, same = suffixes.order(raw, starts, group, 20)
        keys = [(group[i], bytes(raw[starts[i] : starts[i] + 20])) for i in order]
        assert keys == sorted(keys)
        assert [a == b for a, b in zip(keys, keys[1:], strict=False)] == same[1:].tolist()


def test_a_deceiving_hash_is_found_out(monkeypatch):
    raw = np.frombuffer(b"abcdabxd" * 4, np.uint8)
    starts, group = np.array([0, 4, 8]), np.zeros(3, np.int64)
    good = suffixes.Hashes.of
    monkeypatch.setattr(
        suffixes.Hashes, "of",
        lambda self, a, n: np.zeros(len(a), np.uint64) if self.prefix[1] == 98 and self.bad else good(self, a, n),
    )
    made = suffixes.Hashes.__init__

    def init(self, raw, base=suffixes._BASES[0]):
        made(self, raw, base)
        self.bad = base == suffixes._BASES[0]

    monkeypatch.setattr(suffixes.Hashes, "__init__", init)
    order, same = suffixes.order(raw, starts, group, 4)
    assert [bytes(raw[starts[i] : starts[i] + 4]) for i in order] == [b"abcd", b"abcd", b"abxd"]
    assert same.tolist() == [False, True, False]


# Removal of substrings --------------------------------------------------------


def brute_removal(spark, docs):
    """By (id, text): bytes, bytes removed, runs removed, digest of what is left."""
    keys = {(LEAST if d is None else d, t or "") for d, t in docs}
    hashes = spark.createDataFrame([(t,) for _, t in keys], "t string").select("t", F.shiftright(F.xxhash64("t"), 32))
    at = {r[0]: r[1] for r in hashes.collect()}
    seen, found = set(), {}
    for d, t in sorted(keys, key=lambda k: (k[0], at[k[1]])):
        data = t.encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            window = data[i : i + 100]
            if window in seen:
                gone[i : i + 100] = True
            seen.add(window)
        left = np.frombuffer(data, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        found[d, t] = (len(data), int(gone.sum()), runs, hashlib.sha256(left).hexdigest())
    return found


def check_removal(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((str(r.doc_id), *tuple(r)[1:5]) for r in substrings.digests(frame).collect())
    brute = brute_removal(spark, docs)
    assert got == sorted((str(d), *brute[LEAST if d is None else d, t or ""]) for d, t in docs)


@pytest.fixture(scope="module")
def passages():
    random.seed(5)
    made = ["".join(random.choice("abcdé ") for _ in range(random.randint(50, 400))) for _ in range(12)]

    def text():
        parts = (random.choice(made)[a : a + random.randint(30, 300)] for a in (random.randint(0, 60) for _ in range(random.randint(0, 6))))
        return "".join(parts)

    return [(i, text()) for i in range(150)]


def test_removal_is_brute_force(spark, passages):
    more = [(1000, "a" * 500), (1001, "ab" * 300), (1002, "a" * 99), (1003, "a" * 100), (1004, None), (None, "a" * 150)]
    more += [(1005, ""), (3, passages[3][1]), (3, passages[4][1]), (1006, passages[6][1]), (1007, "x" * 3000 + passages[7][1] * 5)]
    check_removal(spark, [*passages, *more])


def test_small_batches_and_groups_change_nothing(spark, passages, monkeypatch):
    import pyarrow as pa

    # _resolved by itself, with rows in batches of one size and another
    rows = [(k, bytes([65 + (k * j) % 3]) * 100 + bytes(30), j % 5, 0, (j << 16) | (30 << 8) | 30) for k in range(7) for j in range(9)]
    rows.sort()
    schema = pa.schema([("key", pa.int64()), ("around", pa.binary()), ("d", pa.int64()), ("o", pa.int64()), ("place", pa.int64())])
    table = pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
    results = []
    for size, most, windows in ((1000, 4000, 400_000), (1, 4000, 400_000), (3, 1, 5)):
        monkeypatch.setattr(substrings, "_ROWS", most)
        monkeypatch.setattr(substrings, "_WINDOWS", windows)
        found = [b for b in substrings._resolved(iter(table.to_batches(max_chunksize=size))) if b.num_rows]
        results.append(sorted(tuple(r.values()) for b in found for r in b.to_pylist()))
    assert results[0] == results[1] == results[2] and results[0]


def texts_with_a_line(n, size):
    random.seed(8)
    own = lambda: "".join(random.choice("abcdefgh ") for _ in range(random.randint(60, 160)))
    line = "".join(random.choice("ijklmnop ") for _ in range(size))
    return [(i, own() + line + (own() if i % 3 else "the same end " * 8)) for i in range(n)]


@pytest.mark.parametrize("piece", [200_000, 150])
def test_windows_of_hot_keys_are_dealt_one_by_one(piece, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(substrings, "_PIECE", piece)
    texts = [t for _, t in texts_with_a_line(300, 60)]
    columns = [pa.array(range(300), pa.int64()), pa.array([0] * 300, pa.int64()), pa.array(texts)]
    batch = pa.RecordBatch.from_arrays(columns, names=["d", "o", "text"])
    places = pa.Table.from_batches(substrings._positions(iter([batch]))).to_pylist()
    asked = [[] for _ in texts]
    for r in places:
        if not r["place"] & substrings._STANDS:
            asked[r["d"]].append({"key": r["key"], "place": r["place"] & ~substrings._KNOWN, "hot": True})
    kind = pa.list_(pa.struct([("key", pa.int64()), ("place", pa.int64()), ("hot", pa.bool_())]))
    whole = batch.append_column("asked", pa.array(asked, kind))
    made = pa.Table.from_batches(substrings._surroundings(iter([whole]))).to_pylist()
    distinct = {(r["key"], r["around"]) for r in made if r["around"] is not None}
    by_key = [k for k, _ in distinct]
    assert len(by_key) == len(set(by_key)) > 1000 and {len(a) for _, a in distinct} == {100}
    # each window is in a row, and known or whole
    count = sum((r["place"] & 63) + 1 for r in made)
    assert count == sum(max(0, len(t) - 99) for t in texts)


@pytest.mark.parametrize("hot", [1, 20])
def test_removal_with_hot_keys_is_brute_force(spark, passages, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    lines = [(5000 + i, t) for i, t in texts_with_a_line(60, 60) + texts_with_a_line(60, 130)]
    check_removal(spark, [*passages, *lines, (3, passages[3][1]), (9000, "a" * 500), (9001, "ab" * 300), (None, "a" * 150)])


def test_texts_of_one_id_with_half_equal_hashes(spark):
    random.seed(12)
    one, other = ("".join(random.choice("abcdefgh ") for _ in range(150)) for _ in range(2))
    text = F.concat(F.col("id").cast("string"), F.when(F.col("id") % 2 == 0, one).otherwise(other))
    rows = spark.range(400_000).select(text.alias("t"), (F.col("id") % 2).alias("kind")).withColumn("half", F.shiftright(F.xxhash64("t"), 32))
    pairs = rows.groupBy("half").agg(F.min("t"), F.max("t"), F.countDistinct("kind").alias("kinds")).where("kinds = 2").collect()
    assert pairs
    check_removal(spark, [(1, one), *((9, t) for p in pairs[:1] for t in (p[1], p[2])), (10, "x" * 40)])


def test_query_of_removal(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r)[1:5] for r in queries.op5_substring_dedup(spark, SF).collect()}
    brute = brute_removal(spark, docs)
    assert got == {d: brute[d, t or ""] for d, t in docs}


def test_removal_of_edges(spark, edges, no_rows):
    found = substrings.removed(edges)
    assert found.columns == edges.columns and found.where("doc_id = 6").count() == 0
    assert found.where("doc_id = 5").first().text and found.where("text is null").count() == 1
    assert substrings.digests(edges).count() == edges.count()
    assert substrings.digests(no_rows).count() == 0 and substrings.removed(no_rows).count() == 0
    # characters stay whole: the repeat starts within one
    a, b = "é" + "x" * 120, "è" + "x" * 120
    left = substrings.removed(spark.createDataFrame([(1, a), (2, "Ã" + b[1:]), (3, b)], "doc_id long, text string"))
    assert {r.doc_id: r.text for r in left.collect()}[3] == "è"


# SimHash ----------------------------------------------------------------------


def brute_print(text, words):
    own = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    own = [b" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if b < a and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_query_of_simhash(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {d: brute_print(t, 4) for d, t in docs.items()}
    want = brute_components(prints, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_simhash(spark, SF).collect()}
    assert got == {d: (f"{p:016x}", want[d]) for d, p in prints.items()}


def test_tiles_find_all_links(spark, monkeypatch):
    random.seed(9)
    monkeypatch.setattr(simhash, "TILE", 16)
    bases = [random.getrandbits(64) for _ in range(12)]
    prints = {i: random.choice(bases) ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 5))) for i in range(400)}
    prints |= {400 + i: i for i in range(100)}  # many that share most of their blocks
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    nodes = spark.createDataFrame(signed, "node long, fp long")
    links = simhash.tile_links(nodes, simhash.by_blocks(4), 4).collect()
    assert all((prints[r.u] ^ prints[r.v]).bit_count() == r.gap <= 4 for r in links)
    found = components.components(spark.createDataFrame([(r.u, r.v) for r in links], "u long, v long")).collect()
    roots = {r.u: r.v for r in found}
    assert {i: roots.get(i, i) for i in prints} == brute_components(prints, 4)


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, 100 + i) for i in range(50)] + [(7, 7), (None, 3), (300, 301), (301, 300)]
    got = {r.u: r.v for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 50)} | {200: 100, 301: 300}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_copies_of_edges(spark, edges, no_rows):
    rows = simhash.digests(edges).collect()
    got = {(r.doc_id, r.component_id) for r in rows}
    assert len(rows) == edges.count() and {(2, 2), (3, 2), (4, 2), (6, 5), (1, 1)} <= got
    assert simhash.digests(no_rows).count() == 0
    kept = simhash.one_of_each(edges)
    assert kept.columns == edges.columns
    assert kept.where("doc_id = 6").count() == 0 and kept.where("doc_id = 5 or doc_id is null").count() == 2
    assert simhash.one_of_each(no_rows).count() == 0


def test_one_of_each_near_copy_stays(spark):
    random.seed(11)
    word = lambda: "".join(random.choice("abcdefghijklmnop") for _ in range(6))
    docs, kept = [], []
    for base in range(40):
        words = [word() for _ in range(300)]
        docs.append((base * 10, " ".join(words)))
        kept.append(base * 10)
        near = list(words)
        for at in random.sample(range(300), 4):
            near[at] = word()
        docs.append((base * 10 + 1, " ".join(near)))  # similarity above 0.8
        docs.append((base * 10 + 2, "  ".join(words).upper()))
        far = [w if random.random() < 0.8 else word() for w in words]
        docs.append((base * 10 + 3, " ".join(far)))  # far below
        kept.append(base * 10 + 3)
    left = simhash.one_of_each(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r.doc_id for r in left.collect()) == kept


def shingles(text, words=5):
    own = text.lower().split()
    return {tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))}


def brute_kept(docs, similarity=0.8):
    """The ids that stay of texts with ids of their own."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if b < a and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted(i for i in root if find(i) == i)


def made_words(n):
    return ["".join(random.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]


def changed(words, n):
    words = list(words)
    for at in random.sample(range(len(words)), n):
        words[at] = made_words(1)[0]
    return words


@pytest.mark.parametrize("tile", [2048, 16])
def test_near_copies_among_texts_of_one_template(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    random.seed(3)
    docs = []
    for _ in range(6):
        template = made_words(300)
        own = [changed(template, 6) for _ in range(30)]  # about 0.7 of each other
        near = [changed(o, random.choice([4, 5, 6, 7])) for o in own]  # about 0.8 of their own
        docs += [" ".join(x) for x in own + near]
    docs = list(enumerate(docs))
    left = simhash.one_of_each(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r.doc_id for r in left.collect()) == brute_kept(docs)


def test_repeated_lines_do_not_hide_near_copies(spark):
    random.seed(4)
    docs = []
    for times in (10, 20, 40):
        for _ in range(30):
            words, line = made_words(300), made_words(12)
            docs.append(" ".join(words + line))
            docs.append(" ".join(changed(words, 2) + line * times))
    docs = list(enumerate(docs))
    assert len(brute_kept(docs)) == len(docs) // 2
    left = simhash.one_of_each(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r.doc_id for r in left.collect()) == brute_kept(docs)


def test_bits_of_sketches_differ_as_stated():
    rng = np.random.default_rng(5)
    factors, gaps = simhash._factors(8 + simhash.BITS), []
    for n in (9, 90, 900) * 40:
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = a.copy()
        b[: n // 9] = rng.integers(0, 1 << 63, n // 9)  # similarity 0.8
        x, y = (simhash.sketch(np.unique(s), factors, 8)[1:3] for s in (a, b))
        gaps.append(int(np.bitwise_count(x ^ y).sum()))
    assert max(gaps) <= 34 and abs(np.mean(gaps) - 12.8) < 1.2 and np.std(gaps) < 4.2


def test_texts_of_one_id_are_nodes_of_their_own(spark):
    random.seed(6)
    a, b, c = (made_words(300) for _ in range(3))
    rows = [(1, a), (1, b), (1, b), (2, changed(a, 3)), (3, changed(b, 3)), (4, c), (4, c), (4, changed(c, 3)), (5, changed(c, 2))]
    docs = [(d, " ".join(t)) for d, t in rows]
    left = sorted(tuple(r) for r in simhash.one_of_each(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert [r for r in left if r[0] != 4] == sorted([docs[0], docs[1]])
    assert len(left) == 3 and left[2] in docs[5:8]
