import hashlib

import pytest

from martloom.llm.warc import read_archives, round_trip, write_archives

LAYOUT = "page_id LONG, url STRING, html STRING"
BIG = "<p>" + "é" * 80 + "</p>"
FALSE = (
    "before\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:667>\r\nContent-Length: 99999\r\n\r\nWARC/1.1\r\nWARC/1.1\r\n"
)
ROWS = [
    (5, "http://a/", BIG), (3, "http://b/\r\nX: y", BIG), (4, None, BIG), (9, "http://c/", ""), (8, "u", None), (7, "u", "short"),
    (6, "u", "short"), (10, "u", FALSE), (11, "u", FALSE), (12, "u", "\r\n\r\n" * 40), (13, "u", "WARC/1.1\r\n"), (14, "u", "x" * 3000),
    (None, "u", BIG), (15, "u", FALSE + "!"), (16, "u", "WARC/1.1\r\n" * 50),
]


def expected(rows):
    out = []
    for i, _, t in rows:
        data = (t or "").encode()
        first = min((j for j, _, x in rows if (x or "") == (t or "") and j is not None), default=None)
        again = len(data) >= 100 and i is not None and i > first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("split", ["128m", "1500b"])
def test_round_trip(spark, tmp_path, split):
    """Payloads hold version lines, false records and record ends; archives are read in one split and in many."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        pages = spark.createDataFrame([(*r, 1) for r in ROWS], LAYOUT + ", digest INT").coalesce(1)
        got = round_trip(pages, str(tmp_path / "w"))
        assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        assert rows_of(got) == expected(ROWS)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_repeated_and_no_rows(spark, tmp_path):
    rows = [(1, "u", BIG)] * 3 + [(2, "u", BIG)] * 2
    got = rows_of(round_trip(spark.createDataFrame(rows, LAYOUT), str(tmp_path / "a")))
    assert [r[3] for r in got] == ["response"] * 3 + ["revisit"] * 2 and got == expected(rows)
    assert rows_of(round_trip(spark.createDataFrame([], LAYOUT), str(tmp_path / "b"))) == []


def test_archives_that_break_off(spark, tmp_path):
    """Records before the break count; a file that does not begin with a record has none."""
    write_archives(spark.createDataFrame(ROWS[:6], LAYOUT).coalesce(1), str(tmp_path / "w"))
    (part,) = (tmp_path / "w").glob("part-*")
    data = part.read_bytes()
    (tmp_path / "cut").mkdir()
    second = data.index(b"WARC/1.1", 9)
    (tmp_path / "cut" / "a.warc").write_bytes(data[:second] + b"broken " + data[second:])
    (tmp_path / "cut" / "b.warc").write_bytes(b"junk" + data)
    found = read_archives(spark, str(tmp_path / "cut")).collect()
    assert [(r.offset, r.file.rsplit("/")[-1]) for r in found] == [(0, "a.warc")]
