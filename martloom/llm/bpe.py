"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece there is one token that its encoding ends with. An automaton over the vocabulary, of the
Aho-Corasick kind, names the tokens that are a suffix of each prefix; the one that goes well with the last token of
the prefix before it is stored. Following these back from the end gives the exact ids, without
merging anything.

Two neighbours go well together when BPE on their joined bytes would leave them apart. Merges run in
order of rank, and a part is only there from its own merge to that of its parent, so it is enough to
look at the parts along the two edges that touch.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martloom.llm.rows import byte_texts, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"

#: What a task remembers: encoded parts by bytes, tested pairs by number. When there is more, parts that were not met again since the
#: last time are forgotten, and all pairs.
REMEMBERED_BYTES = 60_000_000
ENTRY_BYTES = 200
REMEMBERED_PAIRS = 400_000

# Fixed value: the pattern that cuts text into pieces for this family of vocabularies.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def letters_of_bytes() -> dict[str, int]:
    """The visible character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


class Encoder:
    """Encodes bytes of text; built once per worker from a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        letters = letters_of_bytes()
        raw = lambda token: bytes(letters[c] for c in token)
        model = described["model"]
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        ids = {raw(t): i for t, i in model["vocab"].items() if t not in special}
        self.tokens: dict[int, bytes] = {i: t for t, i in ids.items()} | {i: t.encode() for t, i in special.items()}
        self.special = {t.encode(): np.uint32(i).tobytes() for t, i in special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = (raw(x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            pair, whole = (ids[left], ids[right]), ids[left + right]
            self.rank.setdefault(pair, rank)
            parts.setdefault(whole, (*pair, rank))
        self.parts, self.never = parts, len(model["merges"])
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self.cut = regex.compile(PIECES)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.fits: dict[int, bool] = {}
        self.chunks: dict[bytes, bytes | None] = {}
        self.older: dict[bytes, bytes | None] = {}
        self.held = 0

    def _edge(self, token: int, side: int) -> Iterator[tuple[int, int]]:
        """The parts of a token along one side, each with the rank of the merge that uses it up."""
        until = self.never
        while True:
            yield token, until
            if token not in self.parts:
                return
            *sides, until = self.parts[token]
            token = sides[side]

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens apart: no merge across comes before the merges beside it."""
        pair = left << 32 | right
        known = self.fits.get(pair)
        if known is None:
            known = not any(
                (rank := self.rank.get((a, b))) is not None and rank < until_a and rank <= until_b
                for a, until_a in self._edge(left, 1)
                for b, until_b in self._edge(right, 0)
            )
            if len(self.fits) >= REMEMBERED_PAIRS:
                self.fits.clear()
            self.fits[pair] = known
        return known

    def piece(self, data: str) -> list[int]:
        """Ids of one piece, its bytes as characters: the last token of every prefix, then back from the end."""
        last, size, done = [0] * (len(data) + 1), [0] * (len(data) + 1), 0
        fits, compatible = self.fits, self.compatible
        for end, (token, length) in self.automaton.iter(data):
            end += 1
            if end == done:
                continue
            start = end - length
            if start:
                left = last[start]
                good = fits.get(left << 32 | token)
                if not (compatible(left, token) if good is None else good):
                    continue
            last[end], size[end], done = token, length, end
        at = len(data)
        ids = []
        while at:
            ids.append(last[at])
            at -= size[at]
        ids.reverse()
        return ids

    def _by_pieces(self, data: bytes) -> bytes:
        ids: list[int] = []
        for piece in self.cut.findall(data.decode()):
            ids += self.piece(piece if piece.isascii() else piece.encode().decode("latin-1"))
        return array("I", ids).tobytes()

    def _part(self, part: bytes) -> bytes | None:
        """Ids of a part with a space before it; None where it ends in white space, or is empty, and has to be seen with what follows."""
        if not part or part.decode()[-1].isspace():
            return None
        return self._by_pieces(b" " + part)

    def _learn(self, parts: set[bytes], missing: set[bytes]) -> None:
        """Remember the ids of all `parts`, of which some are `missing`; what was not met for long is forgotten first."""
        if self.held > REMEMBERED_BYTES:
            self.older, self.chunks, self.held, missing = self.chunks, {}, 0, parts
        older, chunks = self.older, self.chunks
        for part in missing:
            coded = chunks[part] = older[part] if part in older else self._part(part)
            self.held += ENTRY_BYTES + len(part) + (len(coded) if coded else 0)

    def _plain(self, data: bytes) -> bytes:
        """Ids, as little-endian bytes, of text without special tokens.

        No piece reaches over a space that follows something else than white space, so text is
        taken apart at spaces and most parts are known. A text with white space before a space is
        cut as a whole.
        """
        first, *middle = data.split(b" ")
        if not middle:
            return self._by_pieces(data)
        last = middle.pop()
        if first and first.decode()[-1].isspace():
            return self._by_pieces(data)
        different = set(middle)
        missing = different.difference(self.chunks)
        if missing:
            self._learn(different, missing)
        try:
            coded = b"".join(map(self.chunks.__getitem__, middle))
        except TypeError:  # one of them ends in white space
            return self._by_pieces(data)
        return self._by_pieces(first) + coded + self._by_pieces(b" " + last)

    def encode(self, data: bytes) -> bytes:
        if self.specials is None or not any(s in data for s in self.special):
            return self._plain(data)
        parts = self.specials.split(data.decode())
        return b"".join(self.special.get(p.encode()) or self._plain(p.encode()) for p in parts if p)

    def decode(self, ids: Iterable[int]) -> bytes:
        """UTF-8 bytes of the text; bytes that form no character become the replacement character."""
        return b"".join([self.tokens[i] for i in ids]).decode(errors="replace").encode()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def round_trip(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, n_tokens, ids_sha256, decoded_sha256 of its encoding and decoding.

    Null text counts as empty, which has no ids. Repeated rows give repeated results; an empty table
    gives none. Strings of special tokens in a text become those tokens. `path` must be readable on
    every executor.
    """
    path = path or tokenizer_path(VOCABULARY)
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))

    def encode_and_decode(batches):
        bpe = encoder(path)
        for batch in batches:
            counts, ids_hash, text_hash = [], [], []
            for data in byte_texts(batch):
                ids = bpe.encode(data)
                counts.append(len(ids) // 4)
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256(bpe.decode(np.frombuffer(ids, "<u4").tolist())).hexdigest())
            columns = [batch.column("key"), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            yield pa.record_batch(columns, [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["key"].dataType.simpleString()
    layout = f"`{key}` {kind}, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"
    return rows.mapInArrow(encode_and_decode, layout)


def encoded(docs: DataFrame, path: str | None = None, text: str = "text", into: str = "ids") -> DataFrame:
    """`docs` with an array of token ids per row."""
    from pyspark.sql import types as T

    path = path or tokenizer_path(VOCABULARY)
    layout = T.StructType([*docs.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))])

    def encode(batches):
        bpe = encoder(path)
        for batch in batches:
            ids = [np.frombuffer(bpe.encode(x), "<i4").tolist() for x in byte_texts(batch, text)]
            yield pa.record_batch([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], [*batch.schema.names, into])

    return docs.mapInArrow(encode, layout)
