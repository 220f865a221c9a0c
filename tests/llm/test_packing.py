"""Packing: every id once, in its place, in sequences without padding."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quadloom.llm import byte_ids, packing
from quadloom.llm.packing import Packer, Piece

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def library_ids(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_ids_are_the_librarys(library, edges):
    texts = [r.text or "" for r in edges.select("text").collect()]
    texts += [" " * 5000 + "x", "a" * 5000, "\x85　 x\r\n\r\n  y", "don't <|endoftext|><|endoftext|> '", "1" * 999, "\x00\x1c ﻿"]
    texts += [chr(c) + "a" + chr(c) + " " + chr(c) for c in range(0x20, 0xD800, 97)]
    ids = byte_ids.load(PATH)
    assert [ids(t).tolist() for t in texts] == library_ids(library, texts)


def test_packer_places_best_and_emits_the_fullest():
    out = []
    packer = Packer(10, 2, out.append)

    def add(n, name):
        packer.add(Piece(name, 0, n, bytes(4 * n)))

    add(6, "a")
    add(5, "b")  # does not fit beside a
    add(4, "c")  # fits both: a has less room
    assert [[(p.doc_id, len(p)) for p in w] for w in out] == [[("a", 6), ("c", 4)]]
    add(7, "d")  # opens the second window
    add(4, "e")  # fits b only
    add(8, "f")  # fits none: fills b, the fullest, and opens a window
    assert [(p.doc_id, p.start, len(p)) for p in out[1]] == [("b", 0, 5), ("e", 0, 4), ("f", 0, 1)]
    assert len(packer.open) == 2
    add(25, "g")  # two full windows; five go into the open one with room
    assert [(p.doc_id, p.start, len(p)) for w in out[2:4] for p in w] == [("g", 0, 10), ("g", 10, 10)]
    packer.finish()
    assert not packer.open
    assert all(sum(map(len, w)) in (1, 2, 4, 8, 10) for w in out)
    assert sum(len(p) for w in out for p in w) == 6 + 5 + 4 + 7 + 4 + 8 + 25


def verify(pieces, docs, library, end_id, length):
    """``pieces`` hold each document's ids once, and sequences have no gaps and no padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append(p)
    wanted = defaultdict(list)
    for (doc_id, text), ids in zip(docs, library_ids(library, [t or "" for _, t in docs]), strict=True):
        wanted[doc_id].append([*ids, end_id])
    assert by_doc.keys() == wanted.keys()
    for doc_id, texts in wanted.items():
        got, want = defaultdict(int), defaultdict(int)
        for p in by_doc[doc_id]:
            assert p.length > 0
            got[p.start, p.length, p.ids_crc32, p.doc_tokens] += 1
        if len(texts) > 1:  # rows of one id: all their ids are there
            assert sum(p.length for p in by_doc[doc_id]) == sum(map(len, texts))
            continue
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            own = np.array(texts[0][at : at + p.length], "<u4")
            want[at, len(own), zlib.crc32(own.tobytes()), len(texts[0])] += 1
            at += p.length
        assert at == len(texts[0]) and got == want
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or at < length and at & (at - 1) == 0
    return by_sequence


@pytest.mark.parametrize("tasks", [1, 70])
def test_small_table(spark, library, tasks):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    found = packing.digests(docs.repartition(tasks), PATH).collect()
    sequences = verify(found, rows, library, 0, 1024)
    short = [n for parts in sequences.values() if (n := sum(x for _, x in parts)) < 1024]
    assert len(short) == len(set(short))  # the rest of all, by powers of two


def test_edges(spark, library, edges, no_rows):
    rows = [tuple(r) for r in edges.select("doc_id", "text").collect()]
    verify(packing.digests(edges, PATH, 7, 64).collect(), rows, library, 7, 64)
    assert packing.digests(no_rows, PATH).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in packing.digests(one, PATH).collect()] == [
        (1, 0, 1, zlib.crc32(bytes(4)), 1, packing.pack(one, PATH).first().sequence_id, 0)
    ]
    with pytest.raises(ValueError):
        packing.pack(edges, PATH, length=0)


def test_documents_stay_whole_where_they_fit(spark):
    """Small documents are cut only to fill a window that is full but for less than one of them."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 100).alias("text"))
    pieces = packing.pack(docs, PATH)
    cut = pieces.groupBy("doc_id").count().where("count > 1").count()
    assert cut <= pieces.select("sequence_id").distinct().count() * 1.1
