"""Scores with triples against plain counts."""

import math
import random
import zlib
from collections import Counter

import pytest

from martloom.llm.ngrams import scored

RNG = random.Random(4)
TEXTS = ["the cat sat", "the cat ran", "a dog sat on the mat", None, "", "the the the the", "cat cat dog", "x", "the cat sat on the cat"]
ROWS = [(i, TEXTS[i % 9] if i < 45 else " ".join(RNG.choices(list("abcde"), k=RNG.randrange(12)))) for i in range(90)]
ROWS += [(200 + i, f"only{i} here{i} once{i} the cat sat") for i in range(9)]


def expected(rows, s=10.0):
    tokens = {i: (t or "").split() + [""] for i, t in rows}
    learned = [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    one, two, three = (Counter(g for t in learned for g in zip(*(t[k:] for k in range(n)))) for n in (1, 2, 3))
    n, v = sum(one.values()), len(one)
    p1 = lambda w: (one[(w,)] + 0.5) / (n + 0.5 * (v + 1))
    p2 = lambda b, w: (two[b, w] + s * p1(w)) / (one[(b,)] + s)
    p3 = lambda a, b, w: (three[a, b, w] + s * p2(b, w)) / (two[a, b] + s)
    score = lambda t: sum(
        math.log10(p1(w) if k == 0 else p2(t[0], w) if k == 1 else p3(t[k - 2], t[k - 1], w)) for k, w in enumerate(t)
    )
    return {i: score(t) for i, t in tokens.items()}


@pytest.mark.parametrize("block_bytes, requests", [(1 << 20, 1 << 20), (60, 7)])
def test_scores_with_triples(spark, block_bytes, requests):
    docs = spark.createDataFrame(ROWS, "doc_id LONG, text STRING").repartition(3)
    got = {r.doc_id: r.score for r in scored(docs, block_bytes=block_bytes, bucket_requests=requests, order=3).collect()}
    assert got == pytest.approx(expected(ROWS), abs=1e-9)


def test_nothing_to_ask(spark):
    assert scored(spark.createDataFrame([], "doc_id LONG, text STRING"), order=3).collect() == []
