"""Timestamps and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the raw timestamp layout, one and two digit fields both allowed.
_LAYOUT = "M/d/yyyy h:m:s a"

# Text that the layout certainly parses: a day that exists, then a 12-hour time.
_YEAR = r"(?!0000)\d{4}"
_LEAP_YEAR = r"(?!0000)(\d\d(0[48]|[2468][048]|[13579][26])|([02468][048]|[13579][26])00)"
_DAY = "|".join(
    [
        rf"(0?[13578]|1[02])/(0?[1-9]|[12]\d|3[01])/{_YEAR}",
        rf"(0?[469]|11)/(0?[1-9]|[12]\d|30)/{_YEAR}",
        rf"0?2/(0?[1-9]|1\d|2[0-8])/{_YEAR}",
        rf"0?2/29/{_LEAP_YEAR}",
    ]
)
_VALID = rf"^({_DAY}) (0?[1-9]|1[0-2]):[0-5]?\d:[0-5]?\d [AaPp][Mm]$"

# Months per season.
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}

# Fixed value: first month of the fiscal year.
FISCAL_START = 7


def parse_datetime(col: Column) -> Column:
    """12-hour text to TIMESTAMP_NTZ, NULL when malformed, whatever the session's time zone.

    The strict parser only ever sees text that is known to be valid, so it never throws.
    """
    return F.when(col.rlike(_VALID), F.to_timestamp_ntz(col, F.lit(_LAYOUT)))


def parse_iso(col: Column) -> Column:
    """ISO text such as 2022-01-01T05:00 to TIMESTAMP_NTZ."""
    return col.try_cast("timestamp_ntz")


def date_key(ts: Column) -> Column:
    """YYYYMMDD as INT."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def fiscal_year(day: Column) -> Column:
    return F.year(day) + (F.month(day) >= FISCAL_START).cast("int")


def season(day: Column) -> Column:
    month = F.month(day)
    out = None
    for name, months in SEASONS.items():
        hit = month.isin(*months)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out.otherwise(F.lit("Unknown"))


def calendar(day: Column, week: bool = False) -> list[Column]:
    """The attributes of a calendar day, `week` adding the ISO week number."""
    weekday = F.weekday(day) + 1
    columns = [
        date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 6).cast("int").alias("is_weekend"),
    ]
    if week:
        columns.append(F.weekofyear(day).alias("week"))
    columns += [
        F.quarter(day).alias("quarter"),
        fiscal_year(day).alias("fiscal_year"),
        season(day).alias("season"),
    ]
    return columns
