import hashlib
import re

import pytest
from pyspark.sql import functions as F

from martloom.llm.exact_dedup import duplicates, text_names, without_duplicates
from martloom.llm.rows import numbered

LAYOUT = "doc_id LONG, text STRING"
LONG = "".join(chr(97 + i * i % 26) for i in range(999))
ROWS = [
    (5, "a  b\tc"), (3, "a b c"), (9, "a b c "), (4, None), (8, ""), (2, LONG), (7, LONG), (6, LONG + "x"),
    (1, "x" + LONG), (10, "é ü"), (11, "é  ü"), (12, LONG[:64]), (13, LONG[:64] * 2), (14, " "), (15, "\n\n"), (None, "a b c"),
    (16, LONG + "\x85" + LONG), (17, LONG + "\x85" + LONG),
]


def expected(rows):
    body = {i: re.sub("[\x20\x09-\x0d]+", " ", t or "") for i, t in rows}
    groups = {}
    for i, b in body.items():
        groups.setdefault(b, []).append(i)
    out = {}
    for i, b in body.items():
        keep = min(x for x in groups[b] if x is not None)
        out[i] = (keep, len(groups[b]), i == keep, hashlib.sha256(b.encode()).hexdigest())
    return out


@pytest.mark.parametrize("size", [2, 7, 64, 2048])
def test_matches_brute_force(spark, size):
    rows = duplicates(spark.createDataFrame(ROWS, LAYOUT), block_bytes=size).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == expected(ROWS) and len(rows) == len(ROWS)


def test_hashes_that_stand_for_several_contents(spark):
    """With three hash values for all blocks, names still follow contents."""
    rows = numbered(spark.createDataFrame(ROWS, LAYOUT), "weak")
    weak = text_names(rows, "text", 16, lambda c: F.pmod(F.xxhash64(c), F.lit(3)))
    got = {}
    for r in rows.join(weak, "__row").collect():
        got.setdefault((r["round"], r["name"]), set()).add(r["text"] or "")
    assert all(len(texts) == 1 for texts in got.values())
    assert len(got) == len({t or "" for _, t in ROWS})


def test_repeated_rows_keep_one(spark):
    rows = duplicates(spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None)], LAYOUT)).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in rows) == [
        (0, 0, 1, True), (1, 1, 1, True), (1, 1, 2, False), (1, 1, 2, True)]


def test_empty_table_and_clashing_columns(spark):
    assert duplicates(spark.createDataFrame([], LAYOUT)).collect() == []
    wide = spark.createDataFrame([(1, "a", 2, 3), (2, "a ", 5, 6)], "doc_id LONG, text STRING, name INT, keep_id INT")
    assert sorted(r.keep_id for r in duplicates(wide).collect()) == [1, 2]
    kept = without_duplicates(spark.createDataFrame([(1, "a", 7), (2, "a", 8)], "doc_id LONG, text STRING, h INT"))
    assert kept.collect() == [(1, "a", 7)] and kept.columns == ["doc_id", "text", "h"]
