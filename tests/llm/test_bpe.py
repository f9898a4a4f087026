import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from martloom.llm import bpe
from martloom.llm.rows import tokenizer_path

PATH = tokenizer_path(bpe.VOCABULARY)
PARTS = [
    " ", "  ", "\n", " \n", "\t", "\xa0", " ", "a", "the", "é", "ß", "漢", "1", "23", "'s", "'re", "!", "$$$", "<|endoftext|>", "ﬁ",
    "́", "\x1c", "\x85", "😀", "ab", "​", "Σ", "²", "aaaa", "ͅ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_ids_and_text_match_the_library(library):
    own = bpe.Encoder(PATH)
    for text in [*texts(4000), "", "x" * 3000, "ab " * 2000, " " * 500, "\n\n a"]:
        ids = np.frombuffer(own.encode(text.encode()), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert own.decode(ids).decode() == library.decode(ids, skip_special_tokens=False)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 500)
    monkeypatch.setattr(bpe, "REMEMBERED_PAIRS", 3)
    own = bpe.Encoder(PATH)
    for text in texts(300, 8) + ["one two three four five six seven eight nine ten " * 3]:
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_decoding_of_broken_characters(library):
    own = bpe.Encoder(PATH)
    ids = library.encode("漢é😀", add_special_tokens=False).ids
    for some in (ids[:1], ids[1:], ids[::-1]):
        assert own.decode(some).decode() == library.decode(some, skip_special_tokens=False)


def test_query(spark, library):
    rows = [(i, t, i) for i, t in enumerate([*texts(50, 5), None, ""])] + [(None, "the end", 1), (0, "again", 2)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, n_tokens INT")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode())))
    assert sorted(map(tuple, bpe.round_trip(docs).collect()), key=str) == sorted(want, key=str)
    assert bpe.round_trip(spark.createDataFrame([], docs.schema)).collect() == []
    ids = bpe.encoded(docs, into="tokens").collect()
    assert [r.tokens for r in ids] == [library.encode(t or "", add_special_tokens=False).ids for _, t, _ in rows]
