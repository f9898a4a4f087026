import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from martloom.operators.exact import exact_group


def bits(x):
    return None if x is None else struct.pack(">d", x)


def values(seed):
    rng = random.Random(seed)
    plain = [rng.uniform(-1e3, 1e3) for _ in range(300)]
    wide = [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(-1074, 1000) for _ in range(300)]
    subnormal = [rng.choice([-1, 1]) * rng.randint(1, 9) * 5e-324 for _ in range(30)]
    cancelling = [1e300, 1.0, -1e300, 2.0**-60, 1e16, 1.0, -1e16]
    powers = [s * 2.0**k for k in range(-1074, 1020, 31) for s in (1, -1, 1)]
    halves = [2.0**53, 1.0, 2.0**-80]  # a tie that only the last value breaks
    return {
        "plain": plain, "wide": wide, "subnormal": subnormal, "cancelling": cancelling, "powers": powers,
        "halves": halves, "tie": halves[:2], "negative": [-v for v in halves], "zeros": [0.0, -0.0],
        "gone": [0.1, 0.2, -0.1, -0.2], "one": [0.1], "whole": [float(i) for i in range(1000)], "least": [5e-324],
        "most": [1.7976931348623157e308, -1.7976931348623157e308, 3.0], "border": [math.nextafter(2.0**32, 0), 2.0**32],
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_sums_are_the_nearest_doubles_in_any_order(spark, seed):
    given = values(seed)
    rows = [(k, v) for k, vs in given.items() for v in vs] + [("plain", None), ("none", None)]
    seen = []
    for parts in (1, 5):
        random.Random(parts).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, x double").repartition(parts)
        out = exact_group(df, ["k"], means={"m": "x"}, sums={"s": "x"}, wholes={"n": F.lit(1)}).collect()
        seen.append({r["k"]: (bits(r["m"]), bits(r["s"]), r["n"]) for r in out})
    assert seen[0] == seen[1]
    assert seen[0].pop("none") == (None, None, 1)
    for k, vs in given.items():
        total = math.fsum(vs)
        nulls = k == "plain"
        assert seen[0][k] == (bits(total / len(vs)), bits(total), len(vs) + nulls), k


def test_values_that_are_not_finite(spark):
    inf, nan = math.inf, math.nan
    rows = [("a", inf), ("a", 1.0), ("b", inf), ("b", -inf), ("c", nan), ("c", 2.0), ("d", -inf), (None, 1.0), (None, 2.0)]
    got = {r["k"]: r["s"] for r in exact_group(spark.createDataFrame(rows, "k string, x double"), ["k"], sums={"s": "x"}).collect()}
    assert got["a"] == inf and got["d"] == -inf and math.isnan(got["b"]) and math.isnan(got["c"]) and got[None] == 3.0


def test_without_keys_and_without_rows(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 2), (0.3, None)], "x double, n int")
    row = exact_group(df, [], means={"m": "x"}, sums={"s": F.col("x") * 2}, wholes={"n": "n"}).collect()
    assert [tuple(r) for r in row] == [(math.fsum([0.1, 0.2, 0.3]) / 3, math.fsum([0.2, 0.4, 0.6]), 3)]
    assert [tuple(r) for r in exact_group(df.limit(0), [], means={"m": "x"}).collect()] == [(None,)]
    assert exact_group(df.limit(0), ["n"], means={"m": "x"}).collect() == []


def test_columns_keep_their_names(spark):
    df = spark.createDataFrame([("u", 1.5, 2.5)], "`high` string, `n` double, `a.b` double")
    out = exact_group(df, ["high"], means={"n": "n"}, sums={"low": "a.b"})
    assert [tuple(r) for r in out.collect()] == [("u", 1.5, 2.5)] and out.columns == ["high", "n", "low"]
