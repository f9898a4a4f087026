import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from martloom.llm import rows as shared
from martloom.llm.components import components
from martloom.llm.simhash import fingerprint, forest, links, near_duplicates, without_near_duplicates
from martloom.storage import store

LAYOUT = "doc_id LONG, text STRING"


def plain_print(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "A b c d", "a b\tc\nd e É é\xa0x", "x " * 300])
def test_fingerprint(text):
    assert fingerprint((text or "").encode()) == plain_print(text)


def test_long_texts_are_taken_in_runs(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(400))
    whole = fingerprint(text.encode())
    for size in (1, 5, 64, 333):
        runs = list(shared.word_runs(text.encode(), bytes.lower, 3, size))
        assert [w for i, r in enumerate(runs) for w in r[3 * (i > 0) and min(3, sum(map(len, runs[:i]))) :]][-1] == text.split()[-1].encode()
        monkeypatch.setattr("martloom.llm.simhash.word_runs", lambda d, s, o, n=size: shared.word_runs(d, s, o, n))
        assert fingerprint(text.encode()) == whole == plain_print(text)


def test_forest_connects_like_all_pairs():
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(5)]
    nodes = sorted({s ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for s in seeds for _ in range(30)})
    edges = [(a, b) for a, b in combinations(nodes, 2) if (a ^ b).bit_count() <= 4]
    got = forest(np.array(nodes, np.uint64), 4)
    assert roots_of(nodes, got) == roots_of(nodes, edges) and len(got) < len(nodes)


@pytest.mark.parametrize("crowd", [4096, 3])
def test_links_and_components(spark, crowd):
    """Also when nearly every key is too crowded and the way over values between is taken."""
    rng = random.Random(11)
    seeds = [rng.getrandbits(64) for _ in range(4)]
    nodes = {0, (1 << 64) - 1, 15, 31}
    for s in seeds:
        for _ in range(12):
            nodes.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))))
    signed = [n - (1 << 64) if n >> 63 else n for n in nodes]
    table = store(spark.createDataFrame([(n,) for n in signed], "fp LONG"), "test_prints")
    edges = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    found = {r.node: r.root for r in components(links(table, crowd=crowd)).collect()}
    assert {n: found.get(n, n) for n in signed} == roots_of(signed, edges)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200), (300, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    want = roots_of({n for e in edges for n in e}, edges)
    assert got == {n: r for n, r in want.items()}
    assert components(spark.createDataFrame([], "a LONG, b LONG")).collect() == []


def test_documents(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(3, base), (1, base + " tail"), (2, base.upper()), (9, "quite another text of a few words"), (5, None), (4, "\n"), (None, base), (9, "x y")]
    table = spark.createDataFrame(rows, LAYOUT)
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(table).collect()]
    prints = [(i, plain_print(t)) for i, t in rows]
    want = []
    for i, p in prints:
        reach, grown = {p}, True
        while grown:
            more = {q for _, q in prints for r in reach if (q ^ r).bit_count() <= 4}
            grown, reach = not more <= reach, reach | more
        want.append((i, f"{p:016x}", min(j for j, q in prints if q in reach and j is not None)))
    assert sorted(map(str, got)) == sorted(map(str, want))
    kept = without_near_duplicates(spark.createDataFrame([(*r, 1) for r in rows], LAYOUT + ", fp INT"))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 9, 9]
    assert near_duplicates(spark.createDataFrame([], LAYOUT)).collect() == []
