import random
import zlib
from itertools import groupby

import numpy as np
import pytest
from tokenizers import Tokenizer

from martloom.llm import packing
from martloom.llm.rows import tokenizer_path

PATH = tokenizer_path(packing.VOCABULARY)
LAYOUT = "doc_id LONG, text STRING"
TEXTS = [None, "", " \n", "The cat, the CAT.", "É é ﬁ 漢 1234 it's we're", "<|startoftext|> x <|ENDOFTEXT|>", "a\x85b\xa0c\x1cd", "!!! ... a.b", "word " * 90]


def least_bins(sizes, capacity):
    """Fewest bins by trying everything."""
    best = [len(sizes)]

    def place(rest, rooms):
        if len(rooms) >= best[0]:
            return
        if not rest:
            best[0] = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= rest[0]:
                place(rest[1:], rooms[:i] + [rooms[i] - rest[0]] + rooms[i + 1 :])
        place(rest[1:], rooms + [capacity - rest[0]])

    place(sorted(sizes, reverse=True), [])
    return best[0]


def test_swaps_reach_the_fewest_bins_that_best_fit_misses():
    rng = random.Random(4)
    better = 0
    for _ in range(150):
        sizes = [rng.randrange(12, 51) for _ in range(9)]
        plain = packing.Bins(100)
        plain.best_fit([(n, i) for i, n in enumerate(sizes)])
        bins, squares = len(plain.bins), sum(f * f for f in plain.fill)
        plain.improve()
        assert sorted(i for b in plain.bins for _, i in b) == list(range(9))
        assert all(sum(n for n, _ in b) == f <= 100 for b, f in zip(plain.bins, plain.fill))
        assert sum(f * f for f in plain.fill) >= squares and least_bins(sizes, 100) <= len(plain.bins) <= bins
        better += len(plain.bins) < bins
    assert better


def test_every_step_raises_the_sum_of_squares():
    rng = np.random.default_rng(1)
    packed = packing.Bins(4096)
    packed.best_fit([(int(n), i) for i, n in enumerate(rng.integers(1000, 1700, 400))])
    seen = [sum(f * f for f in packed.fill)]
    exchange = packed._exchange
    packed._exchange = lambda *a: (exchange(*a), seen.append(sum(f * f for f in packed.fill)))
    bins = len(packed.bins)
    packed.improve()
    assert len(seen) > 1 and all(a < b for a, b in zip(seen, seen[1:])) and len(packed.bins) < bins


def test_word_ids_match_the_library(monkeypatch):
    library = Tokenizer.from_file(PATH)
    rng = random.Random(7)
    parts = ["a", "The", " ", "\n", ".", ",", "é", "É", "́", "1", "'s", "!", "<|endoftext|>", "<|EndOfText|>", "漢", "\xa0", "Σ", "word"]
    for limit in (packing.REMEMBERED_BYTES, 400):
        monkeypatch.setattr(packing, "REMEMBERED_BYTES", limit)
        own = packing.Words(PATH)
        for text in ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(1500)]:
            ids = np.frombuffer(own.ids(text.encode()), "<u4").tolist()
            assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("capacity, group", [(4096, 20_000), (16, 20)])
def test_pieces_are_whole_and_sequences_gapless(spark, capacity, group):
    library = Tokenizer.from_file(PATH)
    rows = [(i % 70, TEXTS[i % len(TEXTS)]) for i in range(80)] + [(None, "x")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], LAYOUT + ", sequence_id INT")
    got = packing.packed(docs, capacity=capacity, group=group).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            want.append((i, k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    placed = sorted((r.sequence_id, r.offset, r.length) for r in got)
    total = 0
    for _, members in groupby(placed, key=lambda r: r[0]):
        end = 0
        for _, offset, length in members:
            assert offset == end
            end += length
        assert end <= capacity
        total += 1
    assert total <= -(-sum(r.length for r in got) // capacity) * 1.25 + 1


def test_empty_table_and_ids(spark):
    assert packing.packed(spark.createDataFrame([], LAYOUT)).collect() == []
    row = packing.pieces(spark.createDataFrame([(1, "The cat")], LAYOUT), ids=True).first()
    assert row.ids == Tokenizer.from_file(PATH).encode("The cat", add_special_tokens=False).ids + [1]
