import hashlib
import random

import pytest
import sentencepiece

from martloom.llm import pieces
from martloom.llm.rows import tokenizer_path

PATH = tokenizer_path(pieces.VOCABULARY)
PARTS = [
    " ", "  ", "   ", "\n", " \n", "\t", "\xa0", "▁", "▁▁", "a", "the", " the", "é", "ß", "漢", "1", "23", "'s", "!", "$$$", "</s>", "<0x41>",
    "<unk>", "ﬁ", "́", "\x00", "\x1c", "\x85", "😀", "ab", "​", "Σ", "aaaa", "�", "internationalization", " hello", "xyzzyx",
]
LAYOUT = "doc_id LONG, text STRING, ids INT, block INT, keys STRING, n_tokens INT"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_chunks_match_the_library(library):
    own = pieces.Model(PATH)
    for text in [*texts(4000), "", " ", "    ", "x" * 3000, "ab " * 2000, " " * 500, "\n\n a", "漢字" * 400]:
        for run_bytes in (1, 7, 1 << 22):
            cut = [c for run in pieces.chunks(text.encode(), run_bytes) for c in run]
            if text:
                assert b"".join(b" " + c for c in cut).decode() == " " + text.replace("▁", " ")
            ids = [i for c in cut for i in own.of_chunk(c)] + [own.end]
            assert ids == library.encode(text, add_eos=True), repr(text)
        assert own.decode(ids).decode(errors="replace") == library.decode(ids), repr(text)


def test_both_ways_of_joining_agree(library):
    own = pieces.Model(PATH)
    for text in [*texts(1500, 11), "▁▁▁▁▁▁▁", "aaaaaaaaaaaaaaaa"]:
        for run in pieces.chunks(text.encode()):
            for chunk in run:
                parts = list("▁" + chunk.decode().replace(" ", "▁"))
                assert own._short(list(parts)) == own._long(list(parts))


def test_models_that_change_text_are_refused(tmp_path):
    data = open(PATH, "rb").read()
    changed = data.replace(b"\x0a\x08identity\x12\x00\x18\x01\x20\x00", b"\x0a\x08identity\x12\x00\x18\x01\x20\x01")
    assert changed != data
    (tmp_path / "odd.model").write_bytes(changed)
    with pytest.raises(ValueError):
        pieces.Model(str(tmp_path / "odd.model"))


def expected(library, rows):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_eos=True)
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode(ids).encode())))
    return sorted(want, key=str)


def test_query(spark, library):
    """Nulls, empty, repeated and long texts, ties in the key, clashing columns."""
    some = [*texts(60, 5), None, "", " ", "the end " * 3000, "y" * 5000]
    rows = [(i, t, i, 1, "k", 2) for i, t in enumerate(some)] + [(None, "the end", 1, 1, "k", 2), (0, "again", 2, 1, "k", 2), (0, "again", 2, 1, "k", 2)]
    docs = spark.createDataFrame(rows, LAYOUT)
    assert sorted(map(tuple, pieces.round_trip(docs).collect()), key=str) == expected(library, rows)
    got = pieces.encoded(docs, into="pieces")
    assert sorted((str(r.doc_id), r.pieces) for r in got.collect()) == sorted((str(r[0]), library.encode(r[1] or "", add_eos=True)) for r in rows)
    back = pieces.decoded(got, ids="pieces", into="back").collect()
    assert sorted((str(r.doc_id), r.back) for r in back) == sorted((str(r[0]), (r[1] or "").replace("▁", " ")) for r in rows)
    assert pieces.round_trip(spark.createDataFrame([], LAYOUT)).collect() == []


def test_a_chunk_is_segmented_once_and_full_tables_are_left(library, monkeypatch):
    met = []
    plain = pieces.Model.of_chunk
    monkeypatch.setattr(pieces.Model, "of_chunk", lambda self, c: met.append(c) or plain(self, c))
    encoder = pieces.Encoder(pieces.Model(PATH))
    some = [*texts(300, 8), "one two three one two three"]
    for text in some * 2:
        assert encoder.ids(text.encode()) == library.encode(text, add_eos=True)
    assert len(met) == len(set(met))
    monkeypatch.setattr(pieces, "TABLE_BYTES", 2000)
    for text in some:
        assert encoder.ids(text.encode()) == library.encode(text, add_eos=True)
    assert encoder.table.bytes < 2000 + pieces.ENTRY_BYTES * 40
