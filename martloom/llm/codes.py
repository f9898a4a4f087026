"""Vectors as short codes: one codebook per part of the vector, fitted by rounds that compare little.

A vector is cut into equal consecutive parts; each part is coded by the nearest entry of its codebook. A
round assigns all parts and then moves each entry to the mean of its parts. Rounds after the first
store what they found: the entry of each part and the exact distance to it. A part whose entry did
not move still has that distance, and entries that did not move are no nearer than before, so it is
compared only with entries that moved. All other parts are compared with the whole codebook.

Every number is a whole number and every comparison exact, so ties go to the lower entry whichever way
they are found, and results do not depend on how rows are dealt out.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import vectors
from martloom.operators.keys import attach_key
from martloom.storage import store

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Rows compared at a time, so that a task's distances stay within some tens of MB.
STEP = 4096


@dataclass
class Codebooks:
    """Per part its entries as rows of integers, and which of them moved in the last update."""

    entries: list[np.ndarray]
    moved: list[np.ndarray]

    @property
    def width(self) -> int:
        return self.entries[0].shape[1]

    def updated(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """Entries at the means of their parts, rounded down; entries without parts stay."""
        entries, moved = [], []
        for part, old in enumerate(self.entries):
            new = old.copy()
            for entry in range(len(old)):
                if (part, entry) in sums:
                    n, totals = sums[part, entry]
                    new[entry] = [t // n for t in totals]
            entries.append(new)
            moved.append((new != old).any(axis=1) if self.width else np.zeros(len(old), bool))
        return Codebooks(entries, moved)

    def sha256(self) -> str:
        numbers = (str(v) for book in self.entries for v in book.reshape(-1).tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def reassigned(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, far: np.ndarray, known: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row of `x` and the distance to it, from those of the round before where `known`."""
    code = code.copy()
    active = known & ~moved[code]
    rest = np.flatnonzero(~active)
    if len(rest):
        distances = vectors.squared_distances(x[rest], entries)
        far = far.astype(np.promote_types(far.dtype, distances.dtype))
        code[rest] = distances.argmin(1)
        far[rest] = distances.min(1)
    some, held = np.flatnonzero(moved), np.flatnonzero(active)
    if len(some) and len(held):
        distances = vectors.squared_distances(x[held], entries[some])
        far = far.astype(np.promote_types(far.dtype, distances.dtype))
        best, entry = distances.min(1), some[distances.argmin(1)]
        nearer = (best < far[held]) | ((best == far[held]) & (entry < code[held]))
        code[held[nearer]], far[held[nearer]] = entry[nearer], best[nearer]
    return code, far


def _assigned(state: DataFrame, books: Codebooks) -> DataFrame:
    """`state` with the codes and distances that hold under `books`."""
    parts, width = len(books.entries), books.width
    names = state.columns

    def assign(batches):
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, STEP):
                batch = whole_batch.slice(start, STEP)
                x = vectors.matrix(batch.column("v"), parts * width)
                first = batch.column("codes").null_count == len(batch)
                old_far = None if first else batch.column("far").flatten()
                codes = np.zeros((len(x), parts), np.int64) if first else np.asarray(batch.column("codes").flatten()).reshape(-1, parts).astype(np.int64)
                known = np.zeros(codes.shape, bool) if first else np.asarray(old_far.is_valid()).reshape(-1, parts)
                fars = np.zeros(codes.shape, np.int64) if first else np.asarray(old_far.fill_null(0)).reshape(-1, parts)
                found = [
                    reassigned(x[:, p * width : (p + 1) * width], books.entries[p], books.moved[p], codes[:, p], fars[:, p], known[:, p])
                    for p in range(parts)
                ]
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * parts)
                codes = pa.array(np.stack([c for c, _ in found], 1).reshape(-1), pa.int32())
                fars = vectors.longs(np.stack([f for _, f in found], 1).reshape(-1))
                new = {"codes": pa.ListArray.from_arrays(ends, codes), "far": pa.ListArray.from_arrays(ends, fars)}
                yield pa.record_batch([new.get(n, batch.column(n)) for n in names], names)

    return state.mapInArrow(assign, state.schema)


def _sums(state: DataFrame, books: Codebooks) -> dict[tuple[int, int], tuple[int, list[int]]]:
    parts, width, sizes = len(books.entries), books.width, [len(b) for b in books.entries]

    def add(batches):
        for batch in batches:
            x = vectors.matrix(batch.column("v"), parts * width)
            codes = np.asarray(batch.column("codes").flatten()).reshape(-1, parts)
            yield vectors.sum_rows(
                [
                    (p, entry, digit, n, sums)
                    for p in range(parts)
                    for entry, n, digit, sums in vectors.sums_by_entry(x[:, p * width : (p + 1) * width], codes[:, p], sizes[p])
                ]
            )

    return vectors.added(state.select("v", "codes").mapInArrow(add, vectors.SUMS), width)


def compressed(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    length: int | None = None,
) -> DataFrame:
    """One row per kept vector: key, code (two hex digits a part), error, label_error, codebooks_sha256.

    Components x become floor(1024 * x). Codebooks start as the parts of the vectors with the `entries`
    smallest keys (equal keys by their components, null keys last; fewer vectors give fewer entries) and are moved
    `rounds` times. `error` is the squared distance to the code; `label_error` its sum over equal labels,
    null labels together. An error or sum beyond a long is null.

    Vectors that are null or hold a null or non-finite component are dropped, and so are those of another
    length than `length`, by default the commonest that can be cut into `parts`. Repeated rows count
    and return each for itself. Long vectors are as any. An empty table, or one without a usable vector, gives no rows. Other
    columns, whatever their names, are left aside.
    """
    if not 1 <= entries <= 256:
        raise ValueError(f"{entries} entries do not fit two hex digits")
    own, label_kind = table.schema[key].dataType.simpleString(), table.schema[label].dataType.simpleString()
    if length is None:
        length = vectors.commonest_length(table, vector, parts)
    result = f"`{key}` {own}, code STRING, error BIGINT, label_error BIGINT, codebooks_sha256 STRING"
    if length is None or length % parts:
        return table.sparkSession.createDataFrame([], result)
    kept = table.filter(vectors.usable(table[vector]) & (F.size(table[vector]) == length)).select(
        table[key].alias("key"), table[label].alias("label"), table[vector].cast("array<double>").alias("raw")
    )

    def to_whole(batches):
        for batch in batches:
            v = vectors.scaled(vectors.matrix(batch.column("raw"), length)).reshape(-1)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * length)
            yield pa.record_batch([batch.column("key"), batch.column("label"), pa.ListArray.from_arrays(ends, pa.array(v))], ["key", "label", "v"])

    numbers = kept.mapInArrow(to_whole, f"key {own}, label {label_kind}, v ARRAY<DOUBLE>")
    start = numbers.select("key", "v").orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).collect()
    if not start:
        return table.sparkSession.createDataFrame([], result)
    first = vectors.whole(np.array([r["v"] for r in start], np.float64).reshape(len(start), length))
    width = length // parts
    books = Codebooks(
        [first[:, p * width : (p + 1) * width] for p in range(parts)], [np.ones(len(first), bool) for _ in range(parts)]
    )

    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("codes", "array<int>"), ("far", "array<bigint>"))]
    state = numbers.select("*", *nothing)
    for done in range(rounds):
        state = store(_assigned(state, books), f"codes_{done}")
        books = books.updated(_sums(state, books))
    final = _assigned(state, books)
    hexed = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    far = lambda total, x: total + x.cast("decimal(38,0)")
    error = vectors.as_long(F.aggregate("far", F.lit(0).cast("decimal(38,0)"), lambda t, x: far(t, x).cast("decimal(38,0)")))
    coded = store(final.select("key", "label", hexed.alias("code"), error.alias("error")), "codes")
    by_label = store(coded.groupBy("label").agg(vectors.long_sum(F.col("error")).alias("label_error")), "label_errors")
    joined = attach_key(coded, by_label, [("label", "label")], "label_error", null_safe=True)
    return joined.select(F.col("key").alias(key), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
