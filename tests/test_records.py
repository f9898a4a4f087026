"""CSV in splits against the reader that takes each file whole."""

import random

import numpy as np
import pytest

from martloom.sources.records import CSV, ends, read_csv, read_records


def whole(spark, path):
    return spark.read.options(**CSV, header=True, multiLine=True).csv(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def field(rng):
    text = "".join(rng.choice(["a", "bc", ",", '"', "\n", " ", "é", '""', "x\ny", ",,", "\n\n"]) for _ in range(rng.randrange(7)))
    kind = rng.randrange(4)
    if kind == 0:
        return rng.choice(["", "12", 'six" pipe', "plain", "a b", '5"'])
    return '"' + text.replace('"', '""') + '"'


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_whole_read(spark, small_splits, tmp_path, seed):
    rng = random.Random(seed)
    end = "\r\n" if seed % 3 == 2 else "\n"
    for name in "ab":
        body = ["one,two,three"]
        for _ in range(50):
            body.append(",".join(field(rng) for _ in range(3)))
            body += [""] * (rng.random() < 0.1)
        (tmp_path / f"{name}.csv").write_bytes((end.join(body) + end * rng.randrange(2)).encode())
    path = str(tmp_path)
    got = read_csv(spark, path)
    assert got.columns == ["one", "two", "three"]
    assert rows(got) == rows(whole(spark, path))
    records = read_records(spark, path)
    assert records.select("file").distinct().count() == 2 and read_records(spark, path).groupBy("file", "record").count().filter("count > 1").count() == 0


def test_a_field_over_many_splits(spark, small_splits, tmp_path):
    body = 'k,v\n1,"' + "line, of text\n" * 40 + '"\n2,"short"\n3,"' + 'say ""x""\n' * 30 + 'end"\n'
    (tmp_path / "one.csv").write_text(body)
    path = str(tmp_path / "one.csv")
    assert spark.read.text(path).rdd.getNumPartitions() > 8
    assert rows(read_csv(spark, path)) == rows(whole(spark, path))
    assert len(rows(read_csv(spark, path))) == 3


def test_odd_files(spark, small_splits, tmp_path):
    for name, body in {"header": "a,b\n", "blank": "\n\na,b\n\n1,2\n\n", "short": 'a,b,c\n1\n1,2,3,4\n"x"y,2,3\n'}.items():
        (tmp_path / f"{name}.csv").write_text(body)
        path = str(tmp_path / f"{name}.csv")
        assert rows(read_csv(spark, path)) == rows(whole(spark, path)), name


def test_ends_of_runs():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(1, 9)
        closed, opened = (np.array([rng.random() < 0.5 for _ in range(n)]) for _ in range(2))
        for start in (False, True):
            state, want = start, []
            for a, b in zip(closed, opened):
                state = bool(b) if state else bool(a)
                want.append(state)
            assert ends(closed, opened, start).tolist() == want
