"""SentencePiece encoding and decoding for models of merge type.

``encode`` gives the ids of every text exactly as the model's library does,
without begin or end ids and without sampling; ``decode`` gives the text of
ids. The encoder backtracks instead of merging: it takes the longest token at
each place, found by an Aho-Corasick automaton, as long as it goes with the
token before it. Two tokens go together if merging their joined text gives
just these two again. Where no token at a place goes with the one before, the
place is marked in a bitfield of failed places and the token before is
shortened. An encoding in which all neighbours go together is the one that
merging gives, so the result is exact.

Defined cases: a null text is an empty one and has no ids; null ids decode to
the empty text; characters outside the vocabulary become their bytes; extra
columns, repeated rows and equal ids pass unchanged; an empty table gives an
empty table. A column that has the name of the result is replaced.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quadloom.llm.common import SLICE_BYTES, Known, chunked, fresh, held, in_arrow, lists, on_slices

SPACE = "▁"
KEPT = 200_000  # words, and pairs of tokens, that a worker keeps


class Table:
    """The vocabulary of one model, as read by the library; all that decoding needs."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte: dict[int, int] = {}
        self.bytes: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
                continue
            if model.is_control(i):
                self.bytes.append(b"")
                continue
            self.bytes.append((" ⁇ " if model.is_unknown(i) else piece.replace(SPACE, " ")).encode())
            if not (model.is_unknown(i) or model.is_unused(i)):
                self.id[piece], self.score[piece] = i, model.get_score(i)
        if len(self.byte) != 256 or any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("the model must fall back to bytes and keep spaces at the start of pieces")
        self.single_bytes = set(self.byte.values())
        self.spaced = {i for p, i in self.id.items() if p[0] == SPACE}

    def text(self, ids: list[int]) -> str:
        """The text of ids, without the space before the first word."""
        raw = b"".join(map(self.bytes.__getitem__, ids))
        raw = raw[1:] if self.starts_spaced(ids) else raw
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self.mended(ids)

    def mended(self, ids: list[int]) -> str:
        """The text of ids whose bytes are no text: each run of bytes is decoded by itself."""
        out, run = "", b""
        for i in ids:
            if i in self.single_bytes:
                run += self.bytes[i]
                continue
            out, run = out + replaced(run) + self.bytes[i].decode(), b""
        out += replaced(run)
        return out[1:] if self.starts_spaced(ids) else out

    def starts_spaced(self, ids: list[int]) -> bool:
        """Whether the first piece that shows starts with the space put before a text."""
        return next((i for i in ids if self.bytes[i]), None) in self.spaced


class Pieces(Table):
    """A vocabulary and the encoder over it. Tokens are numbers of ``names``."""

    def __init__(self, path: str, pairs: int = KEPT):
        super().__init__(path)
        self.singles = {p for p in self.id if self.merged(p) == [p]}
        self.names = sorted(self.singles)
        number = {p: i for i, p in enumerate(self.names)}
        self.ids_of = [self.id[p] for p in self.names]
        self.sizes = [len(p) for p in self.names]
        self.shorter = [next((number[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in number), -1) for p in self.names]
        self.automaton = ahocorasick.Automaton()
        for piece, i in number.items():
            self.automaton.add_word(piece, (len(piece) - 1, i))
        self.automaton.make_automaton()
        self.fits = Known(lambda pair: self.compatible(self.names[pair >> 32], self.names[pair & 0xFFFFFFFF]), pairs)

    def merged(self, text: str) -> list[str]:
        """``text`` by merging: the best-scored pair first, the leftmost of equals."""
        parts: list[str | None] = list(text)
        right = list(range(1, len(parts) + 1))
        left = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if i >= 0 and j < len(parts) and (both := parts[i] + parts[j]) in self.score:
                heapq.heappush(heap, (-self.score[both], i, j, both))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if parts[i] is None or j >= len(parts) or parts[j] is None or right[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            right[i] = right[j]
            if right[i] < len(parts):
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [p for p in parts if p is not None]

    def compatible(self, first: str, second: str) -> bool:
        return self.merged(first + second) == [first, second]

    def backtracked(self, text: str) -> list[str]:
        """The tokens of ``text``; every character of it is a token."""
        return [self.names[t] for t in self._tokens(text)]

    def _tokens(self, text: str) -> list[int]:
        # of the matches with one start, the last to end is the longest
        longest = {end - n: token for end, (n, token) in self.automaton.iter(text)}
        size, fits, shorter, sizes = len(text), self.fits, self.shorter, self.sizes
        failed = bytearray(size // 8 + 1)
        tokens: list[int] = []
        at, token, before = 0, longest[0], -1
        while True:
            while token >= 0:
                end = at + sizes[token]
                if not failed[end >> 3] >> (end & 7) & 1 and (before < 0 or fits[before << 32 | token]):
                    break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                if end == size:
                    return tokens
                at, before, token = end, token, longest[end]
                continue
            # nothing fits here after this token: no encoding has a border at this place
            failed[at >> 3] |= 1 << (at & 7)
            at -= sizes[before]
            token = shorter[tokens.pop()]
            before = tokens[-1] if tokens else -1

    def ids(self, chunk: str) -> bytes:
        """The ids of a chunk, in which spaces are written as the model's, as bytes of int32."""
        if self.singles.issuperset(chunk):
            return array("i", map(self.ids_of.__getitem__, self._tokens(chunk))).tobytes()
        found: list[int] = []
        run = ""
        for c in chunk:
            if c in self.singles:
                run += c
                continue
            if run:
                found += map(self.ids_of.__getitem__, self._tokens(run))
                run = ""
            found += [self.byte[b] for b in c.encode()]
        if run:
            found += map(self.ids_of.__getitem__, self._tokens(run))
        return array("i", found).tobytes()


def replaced(raw: bytes) -> str:
    """``raw`` as text, with one mark for every byte that is no part of a character."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def load(path: str, most: int = KEPT) -> tuple[Pieces, Known]:
    return held("pieces", _load, path, most)


def _load(path: str, most: int) -> tuple[Pieces, Known]:
    pieces = Pieces(path, most)
    return pieces, Known(lambda chunk: pieces.ids(chunk.replace(" ", SPACE)), most)


def load_table(path: str) -> Table:
    return held("pieces", Table, path)


def _split(text: str) -> list[str]:
    return re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))


def encode(
    df: DataFrame, model: str, text: str = "text", ids: str = "ids", slice_bytes: int = SLICE_BYTES, kept: int = KEPT
) -> DataFrame:
    """``df`` with the array of token ids of its column ``text``.

    A worker takes up ``slice_bytes`` of text at a time and keeps the results
    of ``kept`` words and pairs of tokens: more of both is faster and takes
    more memory.
    """

    def make():
        _, known = load(model, kept)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            # spaces next to spaces, and the sign that stands for them, may share a token
            offsets, codes, chunks = chunked(batch.column(text), rf"^ |  |{SPACE}", _split)
            values = [known[c if c[:1] in (" ", SPACE) else f" {c}"] for c in chunks]
            own = [batch.column(i) for i, n in enumerate(batch.schema.names) if n.lower() != ids.lower()]
            return pa.RecordBatch.from_arrays([*own, lists(values, codes, offsets)], names=names)

        return one

    fields = [f for f in df.schema if f.name.lower() != ids.lower()]
    names = [*(f.name for f in fields), ids]
    return on_slices(df, text, make, StructType([*fields, StructField(ids, ArrayType(IntegerType()))]), slice_bytes)


def round_trip(df: DataFrame, model: str, text: str = "text", ids: str = "ids", back: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass of a worker: ``df`` with the ids of its texts and what they decode to."""
    fields = [f for f in df.schema if f.name.lower() not in (ids.lower(), back.lower())]
    names = [f.name for f in fields]

    def make():
        pieces, known = load(model)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            offsets, codes, chunks = chunked(batch.column(text), rf"^ |  |{SPACE}", _split)
            values = [known[c if c[:1] in (" ", SPACE) else f" {c}"] for c in chunks]
            found = lists(values, codes, offsets)
            own = [batch.column(batch.schema.get_field_index(n)) for n in names]
            return pa.RecordBatch.from_arrays([*own, found, _texts(pieces, found)], names=[*names, ids, back])

        return one

    schema = StructType([*fields, StructField(ids, ArrayType(IntegerType())), StructField(back, StringType())])
    return on_slices(df, text, make, schema)


def _texts(table: Table, column: pa.ListArray) -> pa.Array:
    """What each list of ids decodes to."""
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return pa.array([table.text(flat[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False)], pa.string())


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of its column of token ids."""
    kept = [f for f in df.schema if f.name.lower() != text.lower()]
    names = [*(f.name for f in kept), text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_table(model)
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            own = [batch.column(i) for i, n in enumerate(batch.schema.names) if n.lower() != text.lower()]
            yield pa.RecordBatch.from_arrays([*own, _texts(pieces, batch.column(ids))], names=names)

    return in_arrow(df, run, StructType([*kept, StructField(text, StringType())]))


def digests(docs: DataFrame, model: str) -> DataFrame:
    """The digest of encoding and decoding: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ids, back = fresh(docs, "ids", "decoded")
    coded = encode(docs.select("doc_id", "text"), model, ids=ids, kept=2 * KEPT)
    coded = decode(coded.drop("text"), model, ids=ids, text=back)
    return coded.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(back).cast("binary"), 256).alias("decoded_sha256"),
    )
