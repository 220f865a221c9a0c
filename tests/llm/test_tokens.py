import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quadloom.llm import byte_ids, codes, counts, pieces, queries
from quadloom.llm.common import Known, chunked, lists

MODEL = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
SIGNS = list("ab e  \n\t\r\x0b\x1c\x85\xa0　▁éß漢字\x00😀thening.#$%1239'st") + ["<|endoftext|>", "<|endoftext", "  ", " 's"]


def made_texts(n=1500):
    random.seed(4)
    texts = ["".join(random.choice(SIGNS) for _ in range(random.randint(0, 40))) for _ in range(n)]
    return [*texts, None, "", " ", "  ", "a ", " a", "▁", "a▁ b", "<s> x</s>", "<0x41>", "the" * 3000, " " * 3000, "漢" * 300]


@pytest.fixture(scope="module")
def spiece():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_pieces_are_the_librarys(spiece):
    texts = made_texts()
    own, known = pieces.load(MODEL)
    offsets, at, chunks = chunked(pa.array(texts, pa.string()), rf"^ |  |{pieces.SPACE}", pieces._split)
    values = [known[c if c[:1] in (" ", pieces.SPACE) else f" {c}"] for c in chunks]
    assert lists(values, at, offsets).to_pylist() == spiece.encode([t or "" for t in texts])


def test_decoding_is_the_librarys(spiece):
    random.seed(5)
    own, _ = pieces.load(MODEL)
    for top in (300, 32_000):
        for _ in range(1500):
            ids = [random.randrange(top) for _ in range(random.randint(0, 6))]
            assert own.text(ids) == spiece.decode(ids), ids


def test_backtracking_is_merging():
    random.seed(6)
    own, _ = pieces.load(MODEL)
    letters = [c for c in "thenaiou▁ers" if c in own.singles]
    for _ in range(400):
        text = "".join(random.choice(letters) for _ in range(random.randint(1, 30)))
        assert own.backtracked(text) == own.merged(text)


def test_pieces_of_edges(spark, edges, no_rows, spiece):
    coded = pieces.decode(pieces.encode(edges, MODEL), MODEL)
    assert set(edges.columns) - {"Decoded"} <= set(coded.columns)
    for r in coded.collect():
        assert r.ids == spiece.encode(r.text or "") and r.decoded == spiece.decode(r.ids)
    assert pieces.encode(no_rows, MODEL).count() == 0 and pieces.digests(no_rows, MODEL).count() == 0


def test_query_of_pieces(spark, spiece):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in docs:
        ids = spiece.encode(r.text or "")
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(spiece.decode(ids)))
    got = {r.doc_id: tuple(r)[1:4] for r in queries.op1_sentencepiece(spark, SF).collect()}
    assert got == want


def test_counts_and_ids_are_the_librarys(library):
    texts = made_texts()
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    merges, known = counts.load(VOCABULARY)
    offsets, at, chunks = chunked(pa.array(texts, pa.string()), merges.cutter.joined, merges.cutter.cut)
    each = np.array([known[c] for c in chunks])
    assert np.diff(np.concatenate([[0], np.cumsum(each[at])])[offsets]).tolist() == list(map(len, want))
    assert [byte_ids.load(VOCABULARY)(t or "").tolist() for t in texts] == want


def test_counts_of_edges(spark, edges, no_rows, library):
    for r in counts.count_tokens(edges, VOCABULARY).collect():
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids)
    assert counts.over_limits(no_rows, VOCABULARY).count() == 0


def test_query_of_counts(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = set()
    for r in docs:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.add((r.doc_id, len((r.text or "").encode()), n, n > 1024))
    assert {tuple(r)[:4] for r in queries.op2_token_counts(spark, SF).collect()} == want


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 20_000])
def test_codes_give_any_token(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 50_257, n).astype(np.uint32)
    ids[::7] = rng.integers(0, 256, len(ids[::7]))
    ids[3::997] = 2**32 - 1
    packed = codes.pack(ids)
    assert (codes.unpack(packed) == ids).all()
    assert all(codes.token_at(packed, i) == ids[i] for i in range(0, n, max(1, n // 500)))
    with pytest.raises(IndexError):
        codes.token_at(packed, n)


def check_files(rows, docs, library):
    want, start = [], 0
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(rows, key=lambda r: r[1]) == want


def test_query_of_codes(spark, library, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    check_files([tuple(r) for r in queries.op7_token_codes(spark, SF).collect()], docs, library)


def test_files_of_edges(spark, edges, no_rows, library):
    texts = edges.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).select("doc_id", "text").collect()
    got = codes.round_trip(edges, VOCABULARY)
    check_files([tuple(r) for r in got.collect()], texts, library)
    assert codes.round_trip(no_rows, VOCABULARY).count() == 0


def test_known_is_bounded():
    asked = []
    known = Known(lambda k: asked.append(k) or k * 2, most=10)
    assert [known[i] for i in range(100)] == [2 * i for i in range(100)]
    assert len(known) + len(known.old) <= 10
    known[1000], known[99], known[99]
    assert asked.count(99) == 1 and known.peek(5) is None
