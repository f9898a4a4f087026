import random
import re

import pytest

from martloom.llm.licenses import PHRASES, TEMPLATES, Templates, scanned, words_of

LAYOUT = "doc_id LONG, text STRING"


def plain_words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def plain_labels(words, templates, threshold):
    """Every block against every template, without any filter."""
    step = max(len(plain_words(t)) for _, t in templates)
    best, labels = 0.0, set()
    for label, text in templates:
        own = set(plain_words(text))
        for at in range(0, max(1, len(words)), step):
            share = len(own & set(words[at : at + 2 * step])) / len(own)
            if share >= threshold - 1e-12:
                best, labels = max(best, share), labels | {label}
    return best, labels


def expected(rows, templates=TEMPLATES, threshold=0.85):
    out = []
    for i, text in rows:
        words = plain_words(text)
        places = []
        for phrase, label in PHRASES.items():
            n = len(phrase.split())
            places += [(k, label) for k in range(len(words) - n + 1) if words[k : k + n] == phrase.split()]
        places.sort()
        own = {label for _, label in places}
        best, labels = plain_labels(words, templates, threshold)
        first, last = (places[0][0], places[-1][0]) if places else (None, None)
        out.append((i, len(words), len(places), first, last, ",".join(sorted(own)), ",".join(sorted(own | labels)), 1.0 if places else best))
    return out


def texts():
    rng = random.Random(3)
    filler = "lorem ipsum the of a work license under version public terms".split()
    out = [None, "", "MIT License", "the mit-license, THE MIT LICENSE", "Ämit license", "general public license mit license apache\nlicense"]
    for label, text in TEMPLATES:
        words = text.split()
        for cut in (0, 1, 3):
            some = [w for k, w in enumerate(words) if k not in set(rng.sample(range(len(words)), min(cut, len(words) - 1)))]
            out.append(" ".join(rng.choices(filler, k=rng.randrange(60)) + some + rng.choices(filler, k=rng.randrange(40))))
    out += [" ".join(rng.choices(filler + ["mit", "cc", "by", "nc", "4", "0"], k=200)) for _ in range(30)]
    return out


@pytest.mark.parametrize("threshold", [0.85, 0.5, 1.0])
def test_matches_brute_force(spark, threshold):
    rows = [(i, t) for i, t in enumerate(texts())] + [(1, "again"), (None, "mit license")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], LAYOUT + ", labels INT")
    got = [tuple(r)[:8] for r in scanned(docs, threshold=threshold).collect()]
    want = expected(rows, threshold=threshold)
    for a, b in zip(got, want):
        assert a[:7] == b[:7] and a[7] == pytest.approx(b[7]), (a, b, rows[got.index(a)])


def test_order_of_words_does_not_change_the_result():
    rng = random.Random(6)
    words = sorted({w for _, t in TEMPLATES for w in words_of(t.encode())})
    for text in texts()[6:]:
        found = [Templates(TEMPLATES, 0.85, {w: rng.randrange(9) for w in words}).matches(words_of(text.encode())) for _ in range(3)]
        assert sorted(found[0]) == sorted(found[1]) == sorted(found[2])


def test_empty_table_and_size_of_templates(spark):
    empty = spark.createDataFrame([], LAYOUT)
    assert scanned(empty).collect() == []
    with pytest.raises(ValueError):
        scanned(empty, templates=[("x", "word " * 300_000)])
