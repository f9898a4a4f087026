import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martloom.llm.quality import BLANKS, DIGITS, LOWER, MARKS, RARE_SYMBOLS, SYMBOLS, UPPER, Limits, _repeated, assessed, passing

LAYOUT = "doc_id LONG, text STRING, lang STRING"
LIMITS = Limits(class_distance=0.3, word_distance=0.4, least_chars=20, least_words=8, common_share=0.05, language_share=0.02)
PLAIN = "The cat and the dog sat on the mat and the bird sang to the cat near the old barn of the farm"
TEXTS = [
    (PLAIN, "en"), (PLAIN.replace("cat", "cow") + "!", "en"), (" ".join(w + "%%%" for w in PLAIN.split()), "en"), (PLAIN.upper(), "en"),
    ("a b c d e f a b c d e f g h i j", "en"), ("x y z " * 30, "en"), ("one\ntwo\none\n \n\none two", "en"), (None, "en"), ("", None),
    ("\t\n  ", "en"), (PLAIN, None), (PLAIN, "xx"), ("Der Hund und die Katze und der Vogel und die Maus sind in der Scheune", "de"),
    ("Die Maus und der Hund und die Katze schlafen in der alten Scheune unter dem Dach", "de"), ("1 2 3 # * $ % & | < > é ß 漢 \x1f", "en"),
    ("word " * 4, "en"), ("a b c d e " * 2, "en"), ("😀 " * 12, "de"), ("a  b\x0bc\x0cd\re\tf g h i j k", "en"),
] + [(PLAIN + f" x{i}", "en") for i in range(20)]
ROWS = [(i, t, lang) for i, (t, lang) in enumerate(TEXTS)] + [(0, PLAIN, "en"), (None, PLAIN, "en")]


def words_of(t):
    return re.findall("[^\x20\x09-\x0d]+", t or "")


def classes_of(t):
    sets = (LOWER, UPPER, DIGITS, BLANKS, MARKS, SYMBOLS, RARE_SYMBOLS)
    counts = [sum(c in s for c in t or "") for s in sets]
    return counts + [len(t or "") - sum(counts)]


def distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    part = lambda a, b: a * math.log2(a / ((a + b) / 2)) if a else 0.0
    return math.sqrt(max(0, sum(part(a, b) + part(b, a) for a, b in zip(p, q)) / 2))


def expected(rows, limits=LIMITS):
    languages = {lang for _, _, lang in rows if lang is not None}
    spoken = {x: Counter(w.lower() for _, t, lang in rows if lang == x for w in words_of(t)) for x in languages}
    everything = sum(sum(c.values()) for c in spoken.values())
    reference = {}
    for x, c in spoken.items():
        n = sum(c.values())
        common = sorted(w for w in c if c[w] >= limits.common_share * n)
        if n >= limits.language_share * everything and common:
            classes = [sum(k) for k in zip(*[classes_of(t) for _, t, lang in rows if lang == x])]
            reference[x] = common, [c[w] for w in common] + [n - sum(c[w] for w in common)], classes
    out = []
    for i, t, lang in rows:
        words, lines = words_of(t), [x for x in (t or "").split("\n") if words_of(x)]
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        often = Counter(windows)
        repeated = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        by_class = by_word = None
        if lang in reference:
            common, counts, classes = reference[lang]
            if len(t or "") >= limits.least_chars:
                by_class = distance(classes_of(t), classes)
            if len(words) >= limits.least_words:
                mine = Counter(w.lower() for w in words)
                by_word = distance([mine[w] for w in common] + [len(words) - sum(mine[w] for w in common)], counts)
        far = (by_class or 0) > limits.class_distance or (by_word or 0) > limits.word_distance
        base = (i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(repeated))
        out.append((*base, failed, not failed and not far, by_class, by_word))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (str(r[0]), str(r[8])))


def test_matches_brute_force(spark):
    got = order(tuple(r) for r in assessed(spark.createDataFrame(ROWS, LAYOUT), LIMITS).collect())
    want = order(expected(ROWS))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:8] == b[:8], (a, b)
        assert a[8:] == pytest.approx(b[8:])
    assert {r[7] for r in want} == {True, False} and any(not r[6] and not r[7] for r in want)


def test_kept_rows_keep_their_columns(spark):
    wide = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(ROWS)], LAYOUT + ", n_words INT, classes STRING")
    kept = passing(wide, LIMITS)
    assert kept.columns == wide.columns
    assert sorted(r.n_words for r in kept.collect()) == [i for i, r in enumerate(expected(ROWS)) if r[7]]


def test_empty_table(spark):
    assert assessed(spark.createDataFrame([], LAYOUT)).collect() == []


def test_windows_are_hashed_by_the_hashes_of_their_words(spark):
    """No window is copied for its hash."""
    words = F.split(F.col("id").cast("string"), " ")
    plan = spark.range(1).select(_repeated(words)).alias("n")._jdf.queryExecution().analyzed().toString()
    assert "xxhash64(" in plan and "xxhash64(slice(" not in plan
