"""SentencePiece BPE through tables of distinct chunks.

Where no piece of the vocabulary holds a white-space marker after another character, no merge reaches over the
start of a marked word: text falls into chunks, each a run of markers and what follows up to the next marker,
that are segmented apart. A task keeps a table of the distinct chunks of its texts with the ids of each, which
is segmented once, when it is met first. A text is the list of places of its chunks in the table, and its ids
are the table's entries joined by place. A table is bounded in bytes; a task goes on with a new one beyond.

One table of all chunks of the corpus was tried first: requests of all blocks of text met by chunk in a shuffle
and went back by block. Most distinct chunks occur in one block only, so that table saved little and the
shuffles cost more than all segmenting; the figures are in the README.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martloom.llm.rows import RUN_BYTES, byte_texts, tokenizer_path

VOCABULARY = "piece_bpe_32k.model"
#: Bytes of a task's table, counted with what Python adds to each entry.
TABLE_BYTES = 150_000_000
ENTRY_BYTES = 300
#: Chunks of no more characters are segmented without a heap.
SHORT = 40

MARKER = "▁"
# Fixed values of the model file: kinds of pieces, the model type, and the field numbers that are read.
NORMAL, CONTROL, BYTE, BPE = 1, 3, 6, 2
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, WORD_END_MARKED, BYTE_FALLBACK, END_ID = 3, 24, 35, 42
CHARACTER_MAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        field, kind = divmod(number(), 8)
        if kind == 0:
            yield field, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield field, data[at : at + size]
        at += size


class Model:
    """A vocabulary file; raises ValueError where chunks would not be independent or the text is changed first."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            parts = list(fields(file.read()))
        trainer, shape = ({k: v for f, x in parts if f == n for k, v in fields(x)} for n in (TRAINER, NORMALIZER))
        entries = [{PIECES: b"", 3: NORMAL, 2: b"\0\0\0\0"} | dict(fields(x)) for f, x in parts if f == PIECES]
        self.pieces = [e[1].decode() for e in entries]
        kinds = [e[3] for e in entries]
        if trainer.get(MODEL_TYPE) != BPE or not trainer.get(BYTE_FALLBACK) or trainer.get(WORD_END_MARKED):
            raise ValueError("not a BPE model with byte fallback and markers before words")
        if shape.get(CHARACTER_MAP) or not shape.get(DUMMY_PREFIX, 1) or shape.get(REMOVE_EXTRA, 1) or not shape.get(ESCAPE, 1):
            raise ValueError("the model changes text beyond marking white space")
        if any(k not in (NORMAL, CONTROL, BYTE, 2) for k in kinds):
            raise ValueError("the model has pieces of its users, or unused ones")
        if any(MARKER in p.lstrip(MARKER) for p, k in zip(self.pieces, kinds) if k == NORMAL):
            raise ValueError("a piece reaches over the start of a word")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == NORMAL}
        self.order = {p: -struct.unpack("<f", entries[i][2])[0] for p, i in self.ids.items()}
        self.end = trainer.get(END_ID, 2)
        self.byte_ids = [0] * 256
        self.raw: list[bytes] = []
        for i, (piece, kind) in enumerate(zip(self.pieces, kinds)):
            if kind == BYTE:
                self.byte_ids[int(piece[1:-1], 16)] = i
            self.raw.append({NORMAL: piece.replace(MARKER, " ").encode(), BYTE: b""}.get(kind, b""))
        for value, i in enumerate(self.byte_ids):
            self.raw[i] = bytes([value])

    def segment(self, chunk: str) -> list[int]:
        """Ids of a chunk: of neighbours whose union is a piece the best are joined first, the left ones of equals."""
        parts = self._short(list(chunk)) if len(chunk) <= SHORT else self._long(list(chunk))
        ids: list[int] = []
        for part in parts:
            i = self.ids.get(part)
            ids += [i] if i is not None else [self.byte_ids[b] for b in part.encode()]
        return ids

    def _short(self, parts: list[str]) -> list[str]:
        """Joins by looking through all neighbours each time, which is quickest for a few."""
        rank, never = self.order.get, math.inf
        ranks = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            i = ranks.index(best)
            whole = parts[i] = parts[i] + parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank(whole + parts[i + 1], never)
            if i:
                ranks[i - 1] = rank(parts[i - 1] + whole, never)
        return parts

    def _long(self, parts: list[str]) -> list[str]:
        """The same with the neighbours in a heap; those whose parts have changed since are passed over."""
        n, order = len(parts), self.order
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = []
        for i in range(n - 1):
            rank = order.get(parts[i] + parts[i + 1])
            if rank is not None:
                waiting.append((rank, i, i + 1, len(parts[i]) + len(parts[i + 1])))
        heapq.heapify(waiting)
        while waiting:
            _, left, right, size = heapq.heappop(waiting)
            a, b = parts[left], parts[right]
            if not a or not b or len(a) + len(b) != size:
                continue
            whole = parts[left] = a + b
            parts[right] = ""
            end = after[left] = after[right]
            if end < n:
                before[end] = left
                rank = order.get(whole + parts[end])
                if rank is not None:
                    heapq.heappush(waiting, (rank, left, end, size + len(parts[end])))
            start = before[left]
            if start >= 0:
                rank = order.get(parts[start] + whole)
                if rank is not None:
                    heapq.heappush(waiting, (rank, start, left, size + len(parts[start])))
        return [part for part in parts if part]

    def of_chunk(self, chunk: bytes) -> list[int]:
        """Ids of a chunk given without its first marker."""
        return self.segment(MARKER + chunk.decode().replace(" ", MARKER))

    def decode(self, ids: Iterable[int]) -> bytes:
        """UTF-8 bytes of the text; the first marker is the model's own."""
        return b"".join([self.raw[i] for i in ids]).removeprefix(b" ")


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


_CHUNK = re.compile(rb" *[^ ]+| +")


def chunks(text: bytes, run_bytes: int = RUN_BYTES) -> Iterator[list[bytes]]:
    """The chunks of a text in order, each without its first marker, in runs of about `run_bytes`.

    Joined with a space before each they give the text again, with its own first marker.
    """
    if not text:
        return
    text = b" " + text.replace(MARKER.encode(), b" ")
    start = 0
    while start < len(text):
        end = start + run_bytes
        while True:  # a run ends before a marker that follows something else
            end = text.find(b" ", end) if end < len(text) else -1
            if end < 0 or text[end - 1] != 0x20:
                break
            end += 1
        run = text[start : end if end >= 0 else len(text)]
        yield [c[1:] for c in _CHUNK.findall(run)] if b"  " in run else run.split(b" ")[1:]
        start += len(run)


class ChunkTable:
    """Distinct chunks and the ids of each, by place."""

    def __init__(self, pieces: Model):
        self.pieces = pieces
        self.place: dict[bytes, int] = {}
        self.ids: list[list[int]] = []
        self.written: list[bytes] = []  # the ids as decimal numbers, a space after each
        self.decoded: list[bytes] = []
        self.bytes = 0

    def places(self, run: list[bytes]) -> list[int]:
        """The place of each chunk of `run`; new ones are segmented and added."""
        pieces, raw = self.pieces, self.pieces.raw
        for chunk in set(run).difference(self.place):
            ids = pieces.of_chunk(chunk)
            self.place[chunk] = len(self.ids)
            self.ids.append(ids)
            self.written.append(" ".join(map(str, ids)).encode() + b" ")
            self.decoded.append(b"".join([raw[i] for i in ids]))
            self.bytes += ENTRY_BYTES + 10 * len(ids) + 2 * len(chunk)
        return list(map(self.place.__getitem__, run))

    @property
    def full(self) -> bool:
        return self.bytes > TABLE_BYTES


class Encoder:
    """Encodes texts through a table that is begun anew when it is full."""

    def __init__(self, pieces: Model):
        self.pieces, self.table = pieces, ChunkTable(pieces)

    def runs(self, text: bytes) -> Iterator[tuple[ChunkTable, list[int]]]:
        """A text as runs of places, each with the table that they are in."""
        for run in chunks(text):
            if self.table.full:
                self.table = ChunkTable(self.pieces)
            yield self.table, self.table.places(run)

    def ids(self, text: bytes) -> list[int]:
        return [i for table, places in self.runs(text) for p in places for i in table.ids[p]] + [self.pieces.end]

    def digests(self, text: bytes) -> tuple[int, str, str]:
        """How many ids, the sha256 of them written with a space between, and that of the text they decode to."""
        n, ids, back = 1, hashlib.sha256(), hashlib.sha256()
        start = b" "  # the model's own, which decoding takes away
        for table, places in self.runs(text):
            written = b"".join(map(table.written.__getitem__, places))
            n += written.count(b" ")
            ids.update(written)
            back.update(b"".join(map(table.decoded.__getitem__, places)).removeprefix(start))
            start = b""
        ids.update(str(self.pieces.end).encode())
        return n, ids.hexdigest(), back.hexdigest()


def round_trip(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, n_tokens, ids_sha256, decoded_sha256 of its encoding and decoding.

    The end id is added to every text and counted. Ids are hashed as decimal numbers joined by a space.
    Null text counts as empty, which has the end id only. Repeated rows give repeated results, equal texts equal ones; an
    empty table gives none. Very long texts are cut in runs. Markers in a text count as spaces, as they do
    for the library. Columns besides key and text, whatever their names, are left aside. `path` must be
    readable on every executor.
    """
    path = path or tokenizer_path(VOCABULARY)
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))

    def encode_and_decode(batches):
        encoder = Encoder(model(path))
        for batch in batches:
            counts, ids, back = zip(*map(encoder.digests, byte_texts(batch))) if batch.num_rows else ((), (), ())
            columns = [batch.column("key"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]
            yield pa.record_batch(columns, [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(encode_and_decode, f"`{key}` {kind}, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING")


def encoded(docs: DataFrame, path: str | None = None, text: str = "text", into: str = "ids") -> DataFrame:
    """`docs` with an array of ids per row, the end id last. Null, empty and long texts as in `round_trip`; a column that
    is named like `into` would be there twice."""
    path = path or tokenizer_path(VOCABULARY)
    layout = T.StructType([*docs.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))])

    def encode(batches):
        encoder = Encoder(model(path))
        for batch in batches:
            ids = pa.array([encoder.ids(x) for x in byte_texts(batch, text)], pa.list_(pa.int32()))
            yield pa.record_batch([*batch.columns, ids], [*batch.schema.names, into])

    return docs.mapInArrow(encode, layout)


def decoded(table: DataFrame, path: str | None = None, ids: str = "ids", into: str = "text") -> DataFrame:
    """`table` with the text of an array of ids; null ids count as none, control ids as nothing, and bytes that form no
    character become the replacement character. Bytes are put together over the whole text."""
    path = path or tokenizer_path(VOCABULARY)
    layout = T.StructType([*table.schema.fields, T.StructField(into, T.StringType())])

    def decode(batches):
        pieces = model(path)
        for batch in batches:
            texts = [pieces.decode(x or []).decode(errors="replace") for x in batch.column(ids).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, into])

    return table.mapInArrow(decode, layout)
