"""Best-fit packing of token pieces into sequences, improved by swaps.

Only lengths take part in packing. Pieces are dealt to groups of bounded size; each group is packed best fit,
longest first, and then improved: pieces move between underfull bins, or change places one for one or
two for one, whenever that makes a fuller bin fuller still. The sum of squared fills rises with
every step, and the emptiest bins run dry. The emptiest bins of neighbouring groups are then opened
and packed together, group by group up a tree, so that what is left over in the end is a few bins in
all and not a few per group.
"""

from __future__ import annotations

import os
import struct
import zlib
from bisect import bisect_left, bisect_right
from functools import reduce
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.bpe import letters_of_bytes
from martloom.llm.rows import ROW, byte_texts, numbered, tokenizer_path, word_runs
from martloom.storage import store

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END = 1

#: Pieces in a group, bins of a group that are opened again, and groups that then become one.
GROUP = 20_000
OPENED = 8
MERGED = 64
#: The emptiest bins that a pass of the search tries to empty, and the most passes.
DONORS = 64
PASSES = 12

#: Encoded words that a worker remembers, in bytes; when there are more, only those met again stay.
REMEMBERED_BYTES = 75_000_000
ENTRY_BYTES = 170

MARKS = b".,;:!?"


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Words:
    """Ids of whole texts by the tokenizers library, word by word.

    The vocabulary's pieces never reach over white space, so a text's ids are those of its words in
    a row, and most words have been met before.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = {b: letter for letter, b in letters_of_bytes().items()}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0

    def ids(self, data: bytes) -> bytes:
        """Little-endian 32-bit ids."""
        # the tokenizer lower-cases too, but only after it has looked for special tokens
        shape = bytes if b"<|" in data else bytes.lower
        return b"".join(self._run(words) for words in word_runs(data, shape))

    def _run(self, words: list[bytes]) -> bytes:
        missing = set(words).difference(self.known)
        if missing:
            if self.held > REMEMBERED_BYTES:
                self.older, self.known, self.held = self.known, {}, 0
                missing = set(words)
            for word in [w for w in missing if w in self.older]:
                self._keep(word, self.older[word])
                missing.discard(word)
            # letters and the marks after them are separate pieces
            ended = {w: len(core) for w in missing if (core := w.rstrip(MARKS)) and core != w and core.decode().isalpha()}
            parts = {x for w, n in ended.items() for x in (w[:n], w[n:])}
            self._learn(sorted((missing - ended.keys() | parts).difference(self.known)))
            for word, n in ended.items():
                self._keep(word, self.known[word[:n]] + self.known[word[n:]])
        return b"".join(map(self.known.__getitem__, words))

    def _learn(self, words: list[bytes]) -> None:
        other, tokenize = [], self.tokenizer.model.tokenize
        for word in words:
            # letters that normalising leaves alone are one piece, which the model takes directly
            if word.isalpha() and word.islower():
                piece = word.decode()
            else:
                text = word.decode()
                if not text.isalpha() or text != text.lower() or not is_normalized("NFC", text):
                    other.append(word)
                    continue
                piece = word.decode("latin-1").translate(self.letters)
            self._keep(word, _packed([t.id for t in tokenize(piece)]))
        found = self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False)
        for word, encoding in zip(other, found):
            self._keep(word, _packed(encoding.ids))

    def _keep(self, word: bytes, ids: bytes) -> None:
        self.known[word] = ids
        self.held += ENTRY_BYTES + len(word) + len(ids)


_words: dict[str, Words] = {}


def pieces(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", ids: bool = False
) -> DataFrame:
    """Pieces of every row of `docs`: key, piece, start, length, ids_crc32 and, on demand, the ids.

    A row's ids are those of its whole text, then `END`; only what is longer than `capacity` is cut.
    """
    path = path or tokenizer_path(VOCABULARY)
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    names = ["key", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
    step = 4 * capacity

    def cut(batches):
        if path not in _words:
            _words[path] = Words(path)
        words = _words[path]
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            own, piece, start, length, crc, whole = [], [], [], [], [], []
            for i, data in enumerate(byte_texts(batch)):
                tokens = words.ids(data) + end
                for k, at in enumerate(range(0, len(tokens), step)):
                    part = tokens[at : at + step]
                    own.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if ids:
                        whole.append(np.frombuffer(part, "<i4").tolist())
            columns = [batch.column("key").take(pa.array(own, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            columns += [pa.array(whole, pa.list_(pa.int32()))] * ids
            yield pa.record_batch(columns, names)

    kind = rows.schema["key"].dataType.simpleString()
    layout = f"key {kind}, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT" + ", ids ARRAY<INT>" * ids
    return rows.mapInArrow(cut, layout)


class Bins:
    """Bins of pieces, each a list of (length, piece) in order of length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.bins: list[list[tuple[int, int]]] = []
        self.fill: list[int] = []

    def best_fit(self, items: list[tuple[int, int]]) -> None:
        """Put each piece, longest first, into the fullest bin that has room."""
        by_room: dict[int, list[int]] = {}
        rooms = 0  # a bit per amount of room that some bin has
        for item in sorted(items, key=lambda x: (-x[0], x[1])):
            size = item[0]
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                b = by_room[room].pop()
                if not by_room[room]:
                    rooms ^= 1 << room
            else:
                room, b = self.capacity, len(self.bins)
                self.bins.append([])
                self.fill.append(0)
            self.bins[b].append(item)
            self.fill[b] += size
            left = room - size
            if left:
                by_room.setdefault(left, []).append(b)
                rooms |= 1 << left
        for b in self.bins:
            b.sort()

    def least(self) -> int:
        return -(-sum(self.fill) // self.capacity)

    def _exchange(self, giver: int, taker: int, given: list[tuple[int, int]], back: list[tuple[int, int]]) -> None:
        for out_of, into, moved in ((giver, taker, given), (taker, giver, back)):
            for item in moved:
                self.bins[out_of].remove(item)
                self.bins[into].insert(bisect_left(self.bins[into], item), item)
        gain = sum(x[0] for x in given) - sum(x[0] for x in back)
        self.fill[giver] -= gain
        self.fill[taker] += gain

    def _step(self, giver: int, taker: int) -> bool:
        """The exchange that fills the taker most: a move, one for one, two for one or one for two."""
        room = self.capacity - self.fill[taker]
        mine, other = self.bins[giver], self.bins[taker]
        best, choice = 0, None
        sizes = [x[0] for x in other]
        gifts = [(a[0], [a]) for a in mine] + [(a[0] + b[0], [a, b]) for i, a in enumerate(mine[:64]) for b in mine[i + 1 : 64]]
        for size, given in gifts:
            if best < size <= room:
                best, choice = size, (given, [])
            # the smallest piece that makes enough room
            at = bisect_left(sizes, size - room)
            if at < len(sizes) and best < size - sizes[at] <= room:
                best, choice = size - sizes[at], (given, [other[at]])
            if len(given) == 1 and best < room and len(other) > 1:
                for i, x in enumerate(sizes[:64]):
                    j = bisect_left(sizes, size - room - x, i + 1)
                    if j < len(sizes) and best < size - x - sizes[j] <= room:
                        best, choice = size - x - sizes[j], (given, [other[i], other[j]])
            if best == room:
                break
        # a giver that is the fuller of the two would lower the sum of squares unless enough moves
        if choice is None or self.fill[taker] + best <= self.fill[giver]:
            return False
        self._exchange(giver, taker, *choice)
        return True

    def improve(self, donors: int = DONORS, passes: int = PASSES) -> None:
        """Empty the emptiest bins into the other underfull ones, until that changes nothing or no bin can be spared."""
        for _ in range(passes):
            moved, spare = False, sum(bool(b) for b in self.bins) - self.least()
            under = sorted((b for b, x in enumerate(self.bins) if x and self.fill[b] < self.capacity), key=self.fill.__getitem__)
            for giver in under[: min(donors, 2 * spare)]:
                for taker in reversed(under):
                    if not self.bins[giver]:
                        break
                    while taker != giver and self.bins[taker] and self.fill[taker] < self.capacity and self._step(giver, taker):
                        moved = True
                        if not self.bins[giver]:
                            break
            if not moved:
                break
        keep = [b for b, x in enumerate(self.bins) if x]
        self.bins, self.fill = [self.bins[b] for b in keep], [self.fill[b] for b in keep]


def pack_group(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins as lists of places in `lengths`, the fullest bins first."""
    packed = Bins(capacity)
    packed.best_fit([(int(n), i) for i, n in enumerate(lengths)])
    packed.improve()
    order = sorted(range(len(packed.bins)), key=lambda b: (-packed.fill[b], b))
    return [[i for _, i in packed.bins[b]] for b in order]


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """(__row, bin, offset) for stored `items` (__row, length) with lengths of 1 to capacity."""
    layout = f"{ROW} BIGINT, length BIGINT, grp BIGINT, bin BIGINT, offset BIGINT, done BOOLEAN"

    def packer(last: bool, level: int):
        def work(table: pa.Table) -> pa.Table:
            table = table.sort_by([("length", "descending"), (ROW, "ascending")])
            lengths = table.column("length").to_numpy()
            bins = pack_group(lengths, capacity)
            closed = len(bins) if last else max(0, len(bins) - OPENED)
            place, number, offset, done = [], [], [], []
            for b, members in enumerate(bins):
                full = b < closed or int(lengths[members].sum()) == capacity
                ends = np.cumsum(lengths[members])
                place += members
                number += [b] * len(members)
                offset += (ends - lengths[members]).tolist()
                done += [full] * len(members)
            taken = table.take(pa.array(place, pa.int64()))
            grp = taken.column("grp")
            code = np.array(number, np.int64) + (grp.to_numpy().astype(np.int64) << 24) + (level << 56)
            columns = [taken.column(ROW), taken.column("length"), grp, pa.array(code), pa.array(offset, pa.int64()), pa.array(done)]
            return pa.table(columns, names=[ROW, "length", "grp", "bin", "offset", "done"])

        return work

    groups = max(1, -(-items.count() // group))
    open_items = items.select(ROW, "length", F.pmod(F.xxhash64(ROW), F.lit(groups)).alias("grp"))
    closed, level = [], 0
    while True:
        packed = store(open_items.groupBy("grp").applyInArrow(packer(groups == 1, level), layout), f"packed_{level}")
        closed.append(packed.filter("done").select(ROW, "bin", "offset"))
        if groups == 1:
            return reduce(DataFrame.unionByName, closed)
        groups, level = -(-groups // MERGED), level + 1
        open_items = packed.filter("NOT done").select(ROW, "length", F.floor(F.col("grp") / MERGED).alias("grp"))


def packed(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, group: int = GROUP, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece of `docs`: key, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of one token. Repeated rows are packed each for itself. An
    empty table gives no rows. Pieces as long as a sequence are one by themselves. Other columns
    are not read.
    """
    rows = numbered(pieces(docs, path, capacity, key, text), "pieces")
    placed = pack(rows.filter(F.col("length") < capacity).select(ROW, "length"), capacity, group)
    columns = [F.col("key").alias(key), "piece", "start", "length", "ids_crc32"]
    whole = rows.filter(F.col("length") == capacity).select(
        *columns, (-F.col(ROW) - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return rows.join(placed, ROW).select(*columns, F.col("bin").alias("sequence_id"), "offset").unionByName(whole)
