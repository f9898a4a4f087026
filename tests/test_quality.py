from datetime import datetime

from pyspark.sql import functions as F

from martloom.plans import quality


def keys(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


def test_key_health_counts_null_repeats_too(spark):
    dim = keys(spark, [1, 2, 2, None, None], "k")
    fact = keys(spark, [1, None, 3], "fk")
    assert tuple(quality.key_health(dim, fact, "k", "fk").first()) == (2, 2, 1)
    assert tuple(quality.key_health(keys(spark, [], "k"), fact, "k", "fk").first()) == (0, 0, 1)


def test_orphans(spark):
    dim = keys(spark, [20220101, None], "k")
    fact = keys(spark, [20220101] * 5 + [20220102] * 7 + [None] * 3 + list(range(1, 16)), "fk")
    rows = {r["key"]: r["rows"] for r in quality.orphan_keys(fact, dim, "fk", "k").collect()}
    assert rows == {20220102: 7, **{i: 1 for i in range(1, 16)}}
    assert [tuple(r) for r in quality.orphan_report(fact, dim, "fk", "k").collect()] == [(22, 16, list(range(1, 11)))]
    assert [tuple(r) for r in quality.orphan_report(dim, dim, "k", "k").collect()] == [(0, 0, [])]


def test_consistency_and_years(spark):
    dim = spark.createDataFrame([(20220101, 2022), (20230101, 2022), (20240101, None), (None, 2022)], "date_key int, year int")
    assert tuple(quality.key_consistency(dim).first()) == (1, 3)
    assert sorted(r[0] for r in quality.years_in(dim, "date_key").collect()) == [2022, 2023, 2024]
    assert [r[0] for r in quality.years_in(dim, "date_key", first=2).collect()] == [2022, 2023]
    many = keys(spark, [y * 10000 + 101 for y in range(1980, 2020)], "date_key")
    assert quality.years_in(many, "date_key").count() == 40


def test_calendar_heatmap(spark):
    dim = spark.createDataFrame([(20220101, 2022, 1, 1), (20220131, 2022, 1, 31), (20230101, 2023, 1, 1)], "date_key int, year int, month int, day int")
    fact = keys(spark, [20220101] * 3 + [20220131, 20230101, 20220505, None], "fk")
    row = quality.calendar_heatmap(fact, dim, "fk", 2022).collect()
    assert len(row) == 1 and (row[0]["1"], row[0]["2"], row[0]["31"]) == (3, 0, 1)


def test_profiles(spark):
    df = spark.createDataFrame([("01/02/2022 03:04:05 PM",), ("x",), ("01/03/2022 03:04:06 PM",)], "INCIDENT_DATETIME string")
    assert tuple(quality.time_coverage(df).first()) == (datetime(2022, 1, 2, 15, 4, 5), datetime(2022, 1, 3, 15, 4, 6), 86401)
    assert tuple(quality.table_overview(df).first()) == (3, 1, "INCIDENT_DATETIME")
    assert quality.preview(df, 2).count() == 2
    watched, seen = quality.counted(df.filter(F.col("INCIDENT_DATETIME") != "x"), "loaded")
    watched.collect()
    assert seen.get == {"rows": 2}


def test_schema_differences(spark):
    left = spark.createDataFrame([], "b int, a string, c double")
    right = spark.createDataFrame([], "a string, b long, d date")
    table = [tuple(r) for r in quality.schema_diff_table(left, right).collect()]
    assert table == [
        ("a", True, True, "string", "string"),
        ("b", True, True, "int", "bigint"),
        ("c", True, False, "double", None),
        ("d", False, True, None, "date"),
    ]
    diff = {r["column"]: (r["part"], r["type_mismatch"]) for r in quality.schema_diff(left, right).collect()}
    assert diff == {"a": ("common", False), "b": ("common", True), "c": ("only_left", False), "d": ("only_right", False)}
