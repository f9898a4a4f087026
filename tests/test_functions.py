from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martloom.functions import bins, numbers, text, times


def test_null_tokens_are_exact(spark, one):
    given = ["", "NA", "null", "NaN", " NA", "na", "x", None]
    assert one(text.null_tokens_to_null, given) == [None, None, None, None, " NA", "na", "x", None]
    df = spark.createDataFrame([(v,) for v in given], "`a b` string")
    assert [r[0] for r in df.select(text.null_tokens_in("a b")).collect()] == [None, None, None, None, " NA", "na", "x", None]


def test_text_strips_all_whitespace_but_no_letters(one):
    given = ["\tfava\n", "   x y \x0b\x0c", "ß", None]
    assert one(text.conform_text, given) == ["FAVA", "X Y", "SS", None]


def test_borough_synonyms(one):
    given = ["\tRichmond / Staten Island ", "RICHMOND", "staten island", "Richmond Hill", None]
    assert one(text.conform_borough, given) == ["STATEN ISLAND"] * 3 + ["RICHMOND HILL", None]


def test_flags(one):
    assert one(text.recode_flag, ["Y", "false", "x", " true", "0", None]) == ["1", "0", "X", "1", "0", None]


def test_whole_numbers(one):
    good = ["10001", "10001.0", " 10001 ", "1e4", "-5", "+7.", "9007199254740993", "1.50e2", "1500e-1", "1234567890.5e1", "0" * 400 + "7"]
    assert one(numbers.to_long, good) == [10001, 10001, 10001, 10000, -5, 7, 9007199254740993, 150, 150, 12345678905, 7]
    bad = ["abc", "10001-1234", "1,000", "1d", "10001.5", "", "inf", "nan", ".", "1e400", "1e305", "99999999999999999999", "1e19", None]
    assert one(numbers.to_long, bad) == [None] * len(bad)


def test_doubles(one):
    good = ["1.5", " -2 ", "1e3", ".5", "5.", "1E-2", "1e305", "1234567890.5e1", "-" + "9" * 308, "0." + "0" * 320 + "1e330"]
    assert one(numbers.to_double, good) == [1.5, -2.0, 1000.0, 0.5, 5.0, 0.01, 1e305, 12345678905.0, -1e308, 1e9]
    bad = ["1d", "1f", "inf", "-inf", "nan", "NaN", "1e400", "9" * 310, "0x1p3", "e5", ".", "", "1 2", None]
    assert one(numbers.to_double, bad) == [None] * len(bad)


def test_seconds_mask(one):
    assert one(numbers.clean_seconds, ["-1", "0", "998.9", "999", "x"]) == [None, 0.0, 998.9, None, None]


def test_threshold_flag_of_unknown_is_zero(one):
    assert one(lambda c: numbers.flag(c > 5), [6.0, 5.0, None], "double") == [1, 0, 0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_datetimes_ignore_the_session_zone(spark, one, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        good = ["01/02/2022 03:04:05 PM", "1/2/2022 3:4:5 pm", "01/02/2022 12:00:00 AM", "12/31/2022 12:59:59 PM", "03/13/2022 02:30:00 AM"]
        assert one(times.parse_datetime, good) == [
            datetime(2022, 1, 2, 15, 4, 5),
            datetime(2022, 1, 2, 15, 4, 5),
            datetime(2022, 1, 2),
            datetime(2022, 12, 31, 12, 59, 59),
            datetime(2022, 3, 13, 2, 30),
        ]
        bad = ["02/30/2022 01:00:00 AM", "01/02/2022 13:04:05 PM", " 01/02/2022 03:04:05 PM", "01/02/22 03:04:05 PM",
               "01/02/2022 00:04:05 AM", "01/02/2022 03:04:05", "01/02/0000 03:04:05 PM", "2022-01-02", "", None]
        assert one(times.parse_datetime, bad) == [None] * len(bad)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_every_calendar_day_and_no_other(one):
    given, want = [], []
    for year in (1900, 2000, 2023, 2024):
        for month in range(0, 14):
            for day in range(0, 33):
                given.append(f"{month:02d}/{day:02d}/{year} 01:00:00 AM")
                try:
                    want.append(datetime(year, month, day, 1))
                except ValueError:
                    want.append(None)
    assert one(times.parse_datetime, given) == want


def test_iso(one):
    assert one(times.parse_iso, ["2022-01-01T05:00", "x", None]) == [datetime(2022, 1, 1, 5), None, None]


def test_calendar_attributes(spark):
    days = [date(2022, 1, 1) + timedelta(days=i) for i in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = {r["d"]: r for r in df.select("d", *times.calendar(F.col("d"), week=True)).collect()}
    season = {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring", 6: "Summer", 7: "Summer", 8: "Summer"}
    for d in days:
        r = rows[d]
        assert r["date_key"] == d.year * 10000 + d.month * 100 + d.day
        assert (r["day_of_week"], r["day_name"], r["is_weekend"]) == (d.isoweekday(), d.strftime("%A"), int(d.isoweekday() > 5))
        assert (r["week"], r["quarter"]) == (d.isocalendar().week, (d.month + 2) // 3)
        assert r["fiscal_year"] == d.year + (d.month >= 7)
        assert r["season"] == season.get(d.month, "Fall")
    assert rows[date(2022, 6, 30)]["fiscal_year"] == 2022 and rows[date(2022, 7, 1)]["fiscal_year"] == 2023
    assert rows[date(2022, 1, 1)]["week"] == 52


def test_bins(one):
    assert one(lambda c: bins.bin_top(c, 5), [0.1, 5.0, 5.1, 105.0, 0.0, -1.0, None], "double") == [5, 5, 10, 105, 0, 0, None]
    assert one(lambda c: bins.bin_floor(c, 5), [0.0, 4.9, 5.0, -0.1, None], "double") == [0, 0, 5, -5, None]
