"""Exact arithmetic on vectors whose components are whole numbers.

Components come as doubles that hold whole numbers. Where every product and sum stays below 2^53 the
arithmetic of doubles is exact and numpy does it; anything larger goes through Python's integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components are multiplied by this and rounded down.
SCALE = 1024.0
#: Doubles hold every whole number up to here.
EXACT = 2**53
#: A sum is sent as parts of 32 bits above this size, so that millions of tasks' parts add up in a long.
LARGE = 2**40
LONG = 2**63


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are there and finite, also once multiplied by SCALE."""
    small = lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < F.lit(float("inf")), F.lit(False))
    return F.coalesce(F.forall(vector, small), F.lit(False))


def commonest_length(table: DataFrame, vector: str, multiple_of: int) -> int | None:
    """The length of most usable vectors among lengths that are multiples of `multiple_of`; of equals the smallest."""
    size = F.size(table[vector])
    kept = table.filter(usable(table[vector]) & (size % multiple_of == 0))
    first = kept.groupBy(size.alias("n")).count().orderBy(F.desc("count"), "n").first()
    return first["n"] if first else None


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of an Arrow batch as doubles, a row per list."""
    return np.asarray(column.flatten(), np.float64).reshape(len(column), width)


def scaled(x: np.ndarray) -> np.ndarray:
    return np.floor(x * SCALE)


def whole(x: np.ndarray) -> np.ndarray:
    """The same numbers as Python's integers."""
    return np.array([int(v) for v in x.reshape(-1)] or [0], object)[: x.size].reshape(x.shape)


def largest(x: np.ndarray) -> int:
    return int(np.abs(x).max()) if x.size else 0


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of `x` (doubles) to those of `entries` (integers): int64, or objects if large."""
    if 4 * max(largest(x), largest(entries)) ** 2 * max(1, x.shape[1]) < EXACT:
        e = entries.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2.0 * (x @ e.T) + (e * e).sum(1)).astype(np.int64)
    found = np.zeros((len(x), len(entries)), object)
    for i, row in enumerate(whole(x)):
        found[i] = ((whole(entries) - row) ** 2).sum(1)
    return found


def sums_by_entry(x: np.ndarray, assigned: np.ndarray, entries: int) -> Iterator[tuple[int, int, int, list[int]]]:
    """(entry, rows, digit, sums) of the rows of each entry: a sum is the total of sums * 2^(32 digit).

    Rows are counted with digit 0 only.
    """
    counts = np.bincount(assigned, minlength=entries)
    if largest(x) * max(1, len(x)) < EXACT:
        totals = np.zeros((entries, x.shape[1]))
        np.add.at(totals, assigned, x)
        totals = whole(totals)
    else:
        totals = np.zeros((entries, x.shape[1]), object)
        np.add.at(totals, assigned, whole(x))
    for entry in np.flatnonzero(counts).tolist():
        rest, rows, digit = totals[entry].tolist(), int(counts[entry]), 0
        while any(abs(v) >= LARGE for v in rest):
            yield entry, rows, digit, [v & 0xFFFFFFFF for v in rest]
            rest, rows, digit = [v >> 32 for v in rest], 0, digit + 1
        yield entry, rows, digit, rest


SUMS = "part INT, entry INT, digit INT, n BIGINT, sums ARRAY<BIGINT>"


def sum_rows(rows: list[tuple[int, int, int, int, list[int]]]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
    columns = list(zip(*rows)) or [()] * 5
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "entry", "digit", "n", "sums"])


def added(sums: DataFrame, width: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Rows and exact sums per (part, entry), from `SUMS` rows of all tasks.

    Spark adds them up. What comes to the driver is as large as the entries, whose number is a parameter.
    """
    each = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
    found: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for row in sums.groupBy("part", "entry", "digit").agg(F.sum("n").alias("n"), *each).collect():
        n, before = found.get((row["part"], row["entry"]), (0, [0] * width))
        more = [row[f"s{i}"] << 32 * row["digit"] for i in range(width)]
        found[row["part"], row["entry"]] = n + row["n"], [a + b for a, b in zip(before, more)]
    return found


def longs(values: np.ndarray) -> pa.Array:
    """Whole numbers as longs, null where one does not fit."""
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([int(v) if -LONG <= v < LONG else None for v in values.tolist()], pa.int64())


def as_long(total: Column) -> Column:
    """A sum of longs, taken in decimals, as a long; null where it does not fit."""
    return total.try_cast("bigint")


def long_sum(value: Column) -> Column:
    """The exact sum as a long; null where it does not fit or a value is null."""
    return F.when(F.count(value) == F.count(F.lit(1)), as_long(F.sum(value.cast("decimal(38,0)"))))
