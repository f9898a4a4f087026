"""One conforming projection per raw table; every dimension and fact reads its result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.numbers import mask_seconds, to_double, to_long
from martloom.functions.text import conform_borough, null_tokens_in
from martloom.functions.times import date_key, parse_datetime

# Raw columns by role. The names come with the files.
DATETIME_COLUMNS = [
    "INCIDENT_DATETIME",
    "FIRST_ASSIGNMENT_DATETIME",
    "FIRST_ON_SCENE_DATETIME",
    "INCIDENT_CLOSE_DATETIME",
    "FIRST_HOSP_ARRIVAL_DATETIME",
    "FIRST_TO_HOSP_DATETIME",
]
SECONDS_COLUMNS = [
    "DISPATCH_RESPONSE_SECONDS_QY",
    "INCIDENT_RESPONSE_SECONDS_QY",
    "INCIDENT_TRAVEL_TM_SECONDS_QY",
]
DURATION_COLUMN = "TOTAL_INCIDENT_DURATION_SECONDS"
UNIT_COLUMNS = [
    "ENGINES_ASSIGNED_QUANTITY",
    "LADDERS_ASSIGNED_QUANTITY",
    "OTHER_UNITS_ASSIGNED_QUANTITY",
]
DISTRICT_COLUMNS = [
    "POLICEPRECINCT",
    "CITYCOUNCILDISTRICT",
    "COMMUNITYDISTRICT",
    "COMMUNITYSCHOOLDISTRICT",
    "CONGRESSIONALDISTRICT",
]
LOCATION_COLUMNS = ["BOROUGH_NORM", "ZIPCODE", *DISTRICT_COLUMNS]

# What the two-fact model reads of the staged tables; the wider model reads everything.
_SHARED_NEEDS = ["INCIDENT_DATETIME", "DATE_KEY", "HOUR", "ZIPCODE", "BOROUGH_NORM", *SECONDS_COLUMNS]
EMS_NEEDS = ["CAD_INCIDENT_ID", "INITIAL_CALL_TYPE", "FINAL_CALL_TYPE", *_SHARED_NEEDS]
FIRE_NEEDS = [
    "STARFIRE_INCIDENT_ID",
    "INCIDENT_CLASSIFICATION",
    "INCIDENT_CLASSIFICATION_GROUP",
    DURATION_COLUMN,
    *UNIT_COLUMNS,
    *_SHARED_NEEDS,
]

EMS_BOROUGH = "BOROUGH"
FIRE_BOROUGH = "INCIDENT_BOROUGH"


def present(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns that `df` has, names compared exactly."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def stage(raw: DataFrame, borough_column: str) -> DataFrame:
    """Conform one raw incident table.

    Text stays as read but for null tokens. Timestamps, zip and districts, seconds and unit counts
    are parsed in place, seconds get a masked `_CLEAN` copy, and BOROUGH_NORM, DATE_KEY and HOUR
    are added.
    """
    converters = {
        **dict.fromkeys(DATETIME_COLUMNS, parse_datetime),
        **dict.fromkeys(["ZIPCODE", *DISTRICT_COLUMNS], to_long),
        **dict.fromkeys([*SECONDS_COLUMNS, DURATION_COLUMN, *UNIT_COLUMNS], to_double),
    }
    parsed = raw.select(
        *[
            (converters[c](F.col(c)) if c in converters else null_tokens_in(c)).alias(c)
            for c in raw.columns
        ]
    )
    added: dict[str, Column] = {
        "BOROUGH_NORM": conform_borough(F.col(borough_column))
        if borough_column in raw.columns
        else F.lit(None).cast("string")
    }
    for c in present(raw, SECONDS_COLUMNS):
        added[f"{c}_CLEAN"] = mask_seconds(F.col(c))
    added["DATE_KEY"] = date_key(F.col("INCIDENT_DATETIME"))
    added["HOUR"] = F.hour("INCIDENT_DATETIME")
    return parsed.withColumns(added)


def needed(staged: DataFrame, columns: list[str]) -> DataFrame:
    """Only these columns, so the others are not even parsed."""
    return staged.select(*present(staged, columns))


def stage_ems(raw: DataFrame) -> DataFrame:
    return stage(raw, EMS_BOROUGH)


def stage_fire(raw: DataFrame) -> DataFrame:
    return stage(raw, FIRE_BOROUGH)
