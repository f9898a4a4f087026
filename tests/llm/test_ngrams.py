import math
import zlib
from collections import Counter

import numpy as np
import pytest

from martloom.llm.ngrams import Automaton, automaton, scored

LAYOUT = "doc_id LONG, text STRING"
TEXTS = ["the cat sat", "The cat ran", "a dog sat\ton the mat", None, "", "é É the the the the", "cat cat dog", "  the  mat  ", "x" * 50, "\n"]
ROWS = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)] + [(7, "the dog ran"), (None, "the cat")]


def tokens_of(text):
    return (text or "").encode().lower().split() + [b""]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1


def expected(rows, strength=10.0):
    learned = [tokens_of(t) for i, t in rows if not held(i)]
    one = Counter(w for t in learned for w in t)
    two = Counter(p for t in learned for p in zip(t, t[1:]))
    n, v = sum(one.values()), len(one)
    p1 = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))
    out = []
    for i, t in rows:
        toks = tokens_of(t)
        score, before = 0.0, None
        for w in toks:
            p = p1(w) if before is None else (two[before, w] + strength * p1(w)) / (one[before] + strength)
            score, before = score + math.log10(p), w
        out.append((i, held(i), len(toks), sum(one[w] > 0 for w in toks), n, sum(math.log10(p1(w)) for w in toks), score))
    return out


def same(got, want):
    order = lambda rows: sorted(rows, key=lambda r: (str(r[0]), r[2], round(r[5], 6)))
    got, want = order(map(tuple, got)), order(want)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-9)


@pytest.mark.parametrize("block_bytes, requests", [(1 << 20, 1 << 20), (30, 7)])
def test_scores(spark, block_bytes, requests):
    """In one block and bucket, and in many small ones."""
    docs = spark.createDataFrame(ROWS, LAYOUT).repartition(3)
    same(scored(docs, block_bytes=block_bytes, bucket_requests=requests).collect(), expected(ROWS))


def test_nothing_to_learn_from(spark):
    rows = [(i, "a b") for i in range(60) if held(i)]
    wide = spark.createDataFrame([(*r, 1, 2) for r in rows], LAYOUT + ", block INT, bucket INT")
    same(scored(wide).collect(), expected(rows))
    assert scored(spark.createDataFrame([], LAYOUT)).collect() == []


def test_probabilities_of_a_context_sum_to_one():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 6, 200)
    n = 6
    counts = np.bincount(text, minlength=n)
    counts[0] = 0
    codes, pairs = np.unique(text[:-1] * n + text[1:], return_counts=True)
    counts[text[-1]] -= 1  # the last word is no context
    made: Automaton = automaton(counts, int(counts.sum()), int((counts > 0).sum()), codes, pairs, 3.0)
    walk = lambda ids: made.walk(np.array(ids), *made.places(np.array(ids)))
    unseen = 0.5 / (counts.sum() + 0.5 * ((counts > 0).sum() + 1))
    for h in range(1, n):
        total = sum(10 ** (walk([h, w]) - walk([h])) for w in range(1, n))
        # word 0 stands for all that was never learned
        total += 10 ** (walk([h, 0]) - walk([h]))
        assert total == pytest.approx(1.0) and unseen > 0
