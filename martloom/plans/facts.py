"""Fact tables: one row per incident, keys attached, measures coerced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.numbers import to_long, zero_if_null
from martloom.functions.text import conform_text, recode_flag
from martloom.operators.keys import attach_key
from martloom.plans.dimensions import EMS, EMS_CODE_DIMS, FIRE, FIRE_CODE_DIMS
from martloom.plans.staging import DURATION_COLUMN, LOCATION_COLUMNS, SECONDS_COLUMNS, UNIT_COLUMNS, present

# Raw measure columns and their names in the facts.
MEASURES = {
    "DISPATCH_RESPONSE_SECONDS_QY": "dispatch_time",
    "INCIDENT_TRAVEL_TM_SECONDS_QY": "travel_time",
    "INCIDENT_RESPONSE_SECONDS_QY": "response_time",
}

# Raw indicator columns, and alarm columns that are passed through.
FLAG_COLUMNS = [
    "HELD_INDICATOR",
    "REOPEN_INDICATOR",
    "SPECIAL_EVENT_INDICATOR",
    "STANDBY_INDICATOR",
    "TRANSFER_INDICATOR",
]
ALARM_COLUMNS = [
    "ALARM_BOX_NUMBER",
    "ALARM_BOX_LOCATION",
    "ALARM_BOX_BOROUGH",
    "HIGHEST_ALARM_LEVEL",
]

# What the wider facts read of their own staged table; of the other they need its location and codes only.
STAR_EMS_NEEDS = [
    "CAD_INCIDENT_ID", "INCIDENT_DATETIME", "DATE_KEY", *LOCATION_COLUMNS, *[f"{c}_CLEAN" for c in SECONDS_COLUMNS],
    *[column for _, _, column in EMS_CODE_DIMS], *FLAG_COLUMNS,
]
STAR_FIRE_NEEDS = [
    "STARFIRE_INCIDENT_ID", "INCIDENT_DATETIME", "DATE_KEY", *LOCATION_COLUMNS, *[f"{c}_CLEAN" for c in SECONDS_COLUMNS],
    *UNIT_COLUMNS, *[column for _, _, column in FIRE_CODE_DIMS], *ALARM_COLUMNS,
]


def _optional(df: DataFrame, column: str, type_name: str) -> Column:
    """The staged column, or a typed NULL where the raw file lacks it."""
    return F.col(column) if column in df.columns else F.lit(None).cast(type_name)


def _attach_shared(staged: DataFrame, location: DataFrame, types: DataFrame, weather: DataFrame, code: str, source: str):
    """The three keys both facts share; each lookup is a broadcast unless counted too big."""
    out = attach_key(
        staged, location, [("ZIPCODE", "zipcode"), ("BOROUGH_NORM", "borough")], "location_key", null_safe=True
    )
    out = attach_key(out, types.filter(F.col("source") == source), [(code, "type_code")], "incident_type_key")
    return attach_key(out, weather, [("DATE_KEY", "date_key"), ("HOUR", "hour")], "weather_key")


def fact_ems(staged: DataFrame, location: DataFrame, types: DataFrame, weather: DataFrame) -> DataFrame:
    keyed = _attach_shared(staged, location, types, weather, "FINAL_CALL_TYPE", EMS)
    return keyed.select(
        to_long(F.col("CAD_INCIDENT_ID")).alias("incident_id"),
        F.col("DATE_KEY").alias("date_key"),
        F.col("HOUR").alias("hour"),
        "location_key",
        "incident_type_key",
        "weather_key",
        *[_optional(staged, c, "double").alias(name) for c, name in MEASURES.items()],
        F.lit(1).alias("nb_interventions"),
        _optional(staged, "INITIAL_CALL_TYPE", "string").alias("initial_call_type"),
        F.col("FINAL_CALL_TYPE").alias("final_call_type"),
    )


def fact_fire(staged: DataFrame, location: DataFrame, types: DataFrame, weather: DataFrame) -> DataFrame:
    keyed = _attach_shared(staged, location, types, weather, "INCIDENT_CLASSIFICATION", FIRE)
    units = [zero_if_null(F.col(c)).cast("int") for c in UNIT_COLUMNS]
    return keyed.select(
        F.col("STARFIRE_INCIDENT_ID").alias("incident_id"),
        F.col("DATE_KEY").alias("date_key"),
        F.col("HOUR").alias("hour"),
        "location_key",
        "incident_type_key",
        "weather_key",
        *[u.alias(c.lower()) for u, c in zip(units, UNIT_COLUMNS)],
        (units[0] + units[1] + units[2]).alias("total_units"),
        *[_optional(staged, c, "double").alias(name) for c, name in MEASURES.items()],
        _optional(staged, DURATION_COLUMN, "double").alias("total_duration"),
        F.lit(1).alias("nb_interventions"),
    )


def attach_location_wide(staged: DataFrame, location: DataFrame, columns: list[str] = LOCATION_COLUMNS) -> DataFrame:
    """Key over every location attribute the model knows; a column the frame lacks counts as null."""
    known = present(location, columns)
    pairs = [(F.col(c) if c in staged.columns else F.lit(None), c) for c in known]
    return attach_key(staged, location, pairs, "location_key", null_safe=True)


def attach_code(staged: DataFrame, dim: DataFrame | None, column: str, key: str) -> DataFrame:
    """Key of a conformed code; NULL throughout when the list or the column is absent."""
    if dim is None or column not in staged.columns:
        return staged.withColumn(key, F.lit(None).cast("bigint"))
    return attach_key(staged, dim, [(conform_text(F.col(column)), column)], key)


def _star_fact(staged: DataFrame, location: DataFrame, codes: dict[str, DataFrame], specs) -> DataFrame:
    out = attach_location_wide(staged, location)
    for table, key, column in specs:
        out = attach_code(out, codes.get(table), column, key)
    return out


def _clean_measures(staged: DataFrame) -> list[Column]:
    return [
        F.col(f"{c}_CLEAN").alias(f"{c.lower()}_seconds") for c in SECONDS_COLUMNS if f"{c}_CLEAN" in staged.columns
    ]


def star_fact_ems(staged: DataFrame, location: DataFrame, codes: dict[str, DataFrame]) -> DataFrame:
    keyed = _star_fact(staged, location, codes, EMS_CODE_DIMS)
    return keyed.select(
        to_long(F.col("CAD_INCIDENT_ID")).alias("ems_incident_id"),
        F.col("INCIDENT_DATETIME").alias("incident_datetime"),
        F.col("DATE_KEY").alias("incident_date_key"),
        "location_key",
        *_clean_measures(staged),
        *[key for _, key, _ in EMS_CODE_DIMS],
        *[recode_flag(F.col(c)).alias(c.lower()) for c in present(staged, FLAG_COLUMNS)],
    )


def star_fact_fire(staged: DataFrame, location: DataFrame, codes: dict[str, DataFrame]) -> DataFrame:
    keyed = _star_fact(staged, location, codes, FIRE_CODE_DIMS)
    return keyed.select(
        F.col("STARFIRE_INCIDENT_ID").alias("fire_incident_id"),
        F.col("INCIDENT_DATETIME").alias("incident_datetime"),
        F.col("DATE_KEY").alias("incident_date_key"),
        "location_key",
        *_clean_measures(staged),
        *[F.col(c).alias(c.lower()) for c in present(staged, UNIT_COLUMNS)],
        *[key for _, key, _ in FIRE_CODE_DIMS],
        *[F.col(c).alias(c.lower()) for c in present(staged, ALARM_COLUMNS)],
    )


def combined(facts: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Facts stacked on the shared columns, each row tagged with its source."""
    tagged = [df.select(*columns, F.lit(tag).alias("source")) for tag, df in facts.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out
