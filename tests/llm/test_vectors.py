"""Codes and clusters of vectors against plain loops over Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from martloom.llm import centroids, codes, vectors

LAYOUT = "vec_id LONG, embedding ARRAY<DOUBLE>, label INT, key STRING, v INT, code INT, chunk INT"


def table(spark, rows):
    return spark.createDataFrame([(i, e, k, "x", 1, 2, 3) for i, e, k in rows], LAYOUT).repartition(3)


def floored(vector):
    return [math.floor(x * 1024) for x in vector]


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def first_nearest(v, entries):
    best = min(range(len(entries)), key=lambda i: (far(v, entries[i]), i))
    return best, far(v, entries[best])


def moved(entries, rows, found):
    new = []
    for i, old in enumerate(entries):
        mine = [v for v, f in zip(rows, found) if f == i]
        new.append([sum(c) // len(mine) for c in zip(*mine)] if mine else old)
    return new


def long_or_none(v):
    return v if v is not None and v < 2**63 else None


def total(values):
    return None if None in values else long_or_none(sum(values))


def plain_codes(rows, length, parts, entries, rounds):
    kept = sorted([(i, e, k) for i, e, k in rows if usable(e) and len(e) == length], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vs = [floored(e) for _, e, _ in kept]
    width, found, numbers = length // parts, [], []
    for p in range(parts):
        cut = [v[p * width : (p + 1) * width] for v in vs]
        book = cut[:entries]
        for _ in range(rounds):
            book = moved(book, cut, [first_nearest(v, book)[0] for v in cut])
        found.append([first_nearest(v, book) for v in cut])
        numbers += [str(c) for e in book for c in e]
    sha = hashlib.sha256(",".join(numbers).encode()).hexdigest()
    out = []
    for n, (i, _, k) in enumerate(kept):
        parts_far = [long_or_none(f[n][1]) for f in found]
        out.append((i, k, "".join(f"{f[n][0]:02x}" for f in found), total(parts_far)))
    by_label = {k: total([r[3] for r in out if r[1] == k]) for k in {r[1] for r in out}}
    return sorted([(i, c, e, by_label[k], sha) for i, k, c, e in out], key=str)


def plain_clusters(rows, length, clusters, rounds):
    kept = [(i, e) for i, e, _ in rows if usable(e) and len(e) == length]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    kept.sort(key=lambda r: (name(r[0]), r[1]))
    vs = [floored(e) for _, e in kept]
    book = vs[:clusters]
    for _ in range(rounds):
        book = moved(book, vs, [first_nearest(v, book)[0] for v in vs])
    found = [(c, long_or_none(d)) for c, d in (first_nearest(v, book) for v in vs)]
    inertia = {c: total([d for x, d in found if x == c]) for c in range(len(book))}
    whole = total([inertia[c] for c in {c for c, _ in found}])
    sha = [hashlib.sha256(",".join(map(str, b)).encode()).hexdigest() for b in book]
    return sorted([(i, c, d, inertia[c], whole, sha[c]) for (i, _), (c, d) in zip(kept, found)], key=str)


def random_rows(seed, n, length, size=1.0):
    """With ties, copies, repeated ids, nulls, non-finite components and other lengths."""
    rng = random.Random(seed)
    points = [[round(rng.gauss(0, size), rng.choice([0, 1, 6])) for _ in range(length)] for _ in range(max(2, n // 3))]
    rows = [(rng.randrange(n), rng.choice(points), rng.choice([None, 1, 2])) for _ in range(n)]
    rows += [(n + i, [rng.gauss(0, size) for _ in range(length)], 3) for i in range(n // 4)]
    odd = [None, [None] * length, [float("nan")] * length, [float("-inf")] + [0.0] * (length - 1), [0.5] * (length + 8), []]
    return rows + [(-1 - i, e, 1) for i, e in enumerate(odd)] + [(None, points[0], None)]


@pytest.mark.parametrize(("seed", "n", "length", "entries"), [(1, 60, 8, 5), (2, 200, 16, 256)])
def test_codes(spark, seed, n, length, entries):
    rows = random_rows(seed, n, length)
    got = codes.compressed(table(spark, rows), entries=entries, length=length)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_codes(rows, length, 4, entries, 4)


@pytest.mark.parametrize(("seed", "n", "length", "clusters"), [(4, 80, 8, 3), (5, 150, 40, 8), (6, 4, 6, 8)])
def test_clusters(spark, seed, n, length, clusters):
    rows = random_rows(seed, n, length)
    rounds = 10 if n == 80 else 2
    got = centroids.clustered(table(spark, rows), length=length, clusters=clusters, chunk_rows=7, rounds=rounds)
    assert sorted(map(tuple, got.collect()), key=str) == plain_clusters(rows, length, clusters, rounds)


@pytest.mark.parametrize("size", [3e5, 1e8, 1e30])
def test_large_components(spark, size):
    """Beyond exact doubles, and beyond longs."""
    rows = random_rows(7, 24, 8, size)
    got = codes.compressed(table(spark, rows), entries=4, length=8, rounds=2)
    assert sorted(map(tuple, got.collect()), key=str) == plain_codes(rows, 8, 4, 4, 2)
    got = centroids.clustered(table(spark, rows), length=8, clusters=3, shard_columns=3, chunk_rows=5, rounds=2)
    assert sorted(map(tuple, got.collect()), key=str) == plain_clusters(rows, 8, 3, 2)


def test_nothing_to_do(spark):
    for rows in ([], [(1, None, 1), (2, [float("nan")] * 64, 1)]):
        assert codes.compressed(table(spark, rows)).collect() == []
        assert centroids.clustered(table(spark, rows)).collect() == []


def test_long_vectors(spark):
    rows = random_rows(8, 12, 3000)
    got = codes.compressed(table(spark, rows), entries=3, rounds=2)
    assert sorted(map(tuple, got.collect()), key=str) == plain_codes(rows, 3000, 4, 3, 2)
    got = centroids.clustered(table(spark, rows), length=3000, clusters=2, shard_columns=512, rounds=2)
    assert sorted(map(tuple, got.collect()), key=str) == plain_clusters(rows, 3000, 2, 2)


def test_only_moved_entries_are_compared():
    """A held row takes a moved entry when nearer, or as near and lower; others stay."""
    entries = np.array([[0], [10], [20], [4]], object)
    x = np.array([[1.0], [9.0], [2.0], [19.0]])
    code, known = np.array([0, 1, 0, 2]), np.array([True, True, True, False])
    far = np.array([1, 1, 4, 99])
    got = codes.reassigned(x, entries, np.array([False, False, False, True]), code, far, known)
    assert got[0].tolist() == [0, 1, 0, 2] and got[1].tolist() == [1, 1, 4, 1]
    got = codes.reassigned(x, entries, np.array([True, False, False, False]), np.array([3, 1, 3, 2]), np.array([9, 1, 4, 1]), known)
    assert got[0].tolist() == [0, 1, 0, 2] and got[1].tolist() == [1, 1, 4, 1]


def test_packing():
    for x in ([[1, -2], [3, 4]], [[40000, 1]], [[2**40, -1]], [[2**70, -(2**71)]], [[0]]):
        m = np.array(x, object)
        assert centroids.unpacked(centroids.packed(m), len(x)).tolist() == x


def test_sums_add_up():
    x = np.array([[1e30, -5.0], [-3e30, 7.0], [2.0, 2.0]])
    found = {}
    for entry, n, digit, sums in [(e, n, d, s) for e, n, d, s in vectors.sums_by_entry(x, np.array([0, 0, 1]), 3)]:
        rows, before = found.get(entry, (0, [0, 0]))
        found[entry] = rows + n, [a + (b << 32 * digit) for a, b in zip(before, sums)]
    assert found == {0: (2, [int(1e30) - int(3e30), 2]), 1: (1, [2, 2])}
