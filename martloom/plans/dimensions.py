"""Conformed dimensions of both models.

Every incident argument is a staged frame (see `staging`). Dimensions are distinct by
construction: partial aggregation keeps only distinct values before anything is shuffled, so a
value that fills a third of the rows costs one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.numbers import flag, to_double, to_long
from martloom.functions.text import conform_borough, conform_text, null_tokens_in, null_tokens_to_null
from martloom.functions.times import calendar, date_key, parse_iso
from martloom.operators.keys import dense_key
from martloom.plans.staging import DATETIME_COLUMNS, LOCATION_COLUMNS, present
from martloom.storage import store

# Temperatures beyond which an hour counts as hot or cold, in Fahrenheit.
HOT_ABOVE = 90
COLD_BELOW = 32

# The source tags and the one category of the medical source.
EMS = "EMS"
FIRE = "FIRE"
EMS_CATEGORY = "Medical"

# What a row of a shared dimension is known by, in the order of its keys.
LOCATION_ORDER = ["borough", "zipcode"]
TYPE_ORDER = ["source", "type_code"]
HOUR_ORDER = ["date_key", "hour"]

# Code dimensions as (table, key, raw column).
EMS_CODE_DIMS = [
    ("dim_ems_initial_call_type", "ems_initial_call_type_key", "INITIAL_CALL_TYPE"),
    ("dim_ems_final_call_type", "ems_final_call_type_key", "FINAL_CALL_TYPE"),
    ("dim_ems_initial_severity", "ems_initial_severity_key", "INITIAL_SEVERITY_LEVEL_CODE"),
    ("dim_ems_final_severity", "ems_final_severity_key", "FINAL_SEVERITY_LEVEL_CODE"),
    ("dim_ems_disposition", "ems_disposition_key", "INCIDENT_DISPOSITION_CODE"),
]
FIRE_CODE_DIMS = [
    ("dim_fire_class_group", "fire_class_group_key", "INCIDENT_CLASSIFICATION_GROUP"),
    ("dim_fire_class", "fire_class_key", "INCIDENT_CLASSIFICATION"),
    ("dim_fire_alarm_source", "fire_alarm_source_key", "ALARM_SOURCE_DESCRIPTION_TX"),
    ("dim_fire_alarm_level", "fire_alarm_level_key", "ALARM_LEVEL_INDEX_DESCRIPTION"),
]


def _union(frames: list[DataFrame], fill: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), frames)


def dim_time(frames: list[DataFrame], datetime_columns: list[str] | None = None, week: bool = False) -> DataFrame:
    """Calendar of the days on which any of the timestamps falls; one scan per frame."""
    wanted = datetime_columns or ["INCIDENT_DATETIME"]
    days = []
    for df in frames:
        columns = present(df, wanted)
        if len(columns) == 1:
            days.append(df.select(F.to_date(columns[0]).alias("date")))
        elif columns:
            days.append(df.select(F.explode(F.array(*[F.to_date(c) for c in columns])).alias("date")))
    distinct = _union(days).dropna().distinct()
    return distinct.select("date", *calendar(F.col("date"), week=week))


def dim_time_wide(frames: list[DataFrame]) -> DataFrame:
    """Calendar over every timestamp column, with ISO week."""
    return dim_time(frames, DATETIME_COLUMNS, week=True)


def location_rows(frames: list[DataFrame], apart: tuple[str, ...] = ()) -> DataFrame:
    """(zipcode, borough) pairs, per value of the columns `apart`; no zip, no row; an unknown borough is kept."""
    pairs = [df.select(F.col("ZIPCODE").alias("zipcode"), F.col("BOROUGH_NORM").alias("borough"), *apart) for df in frames]
    return _union(pairs).dropna(subset=["zipcode"]).distinct()


def dim_location(frames: list[DataFrame]) -> DataFrame:
    return dense_key(location_rows(frames), "location_key", LOCATION_ORDER)


def dim_location_wide(frames: list[DataFrame], columns: list[str] = LOCATION_COLUMNS) -> DataFrame:
    """All location attributes that any frame has, nulls kept."""
    parts = [df.select(*present(df, columns)) for df in frames]
    rows = _union(parts, fill=True)
    ordered = present(rows, columns)
    return dense_key(rows.select(*ordered).distinct(), "location_key", ordered)


def site_rows(raw: DataFrame) -> DataFrame:
    """Site list reduced to name, area, address and position."""
    table = {
        "firehouse_name": ("FacilityName", null_tokens_to_null),
        "zipcode": ("Postcode", to_long),
        "borough": ("Borough", lambda c: conform_borough(null_tokens_to_null(c))),
        "FacilityAddress": ("FacilityAddress", null_tokens_to_null),
        "Latitude": ("Latitude", to_double),
        "Longitude": ("Longitude", to_double),
    }
    columns = [f(F.col(c)).alias(name) for name, (c, f) in table.items() if c in raw.columns]
    return raw.select(*columns).distinct()


def dim_site(raw: DataFrame) -> DataFrame:
    rows = site_rows(raw)
    return dense_key(rows, "firehouse_key", rows.columns)


def dim_site_wide(raw: DataFrame) -> DataFrame:
    """Site list with all of its columns, conformed borough added."""
    rows = raw.select(*[null_tokens_in(c).alias(c) for c in raw.columns])
    if "Borough" in raw.columns:
        rows = rows.withColumn("Borough_Norm", conform_borough(F.col("Borough")))
    if "Postcode" in raw.columns:
        rows = rows.withColumn("Postcode", to_long(F.col("Postcode")))
    return dense_key(rows.distinct(), "firehouse_key", rows.columns)


def bridge_area_site(sites_wide: DataFrame) -> DataFrame:
    """Many-to-many link of areas and sites."""
    return (
        sites_wide.select(
            "firehouse_key",
            F.col("Postcode").alias("ZIPCODE"),
            F.col("Borough_Norm").alias("BOROUGH_NORM"),
        )
        .dropna(subset=["ZIPCODE"])
        .distinct()
    )


def type_rows(ems: DataFrame, fire: DataFrame, apart: tuple[str, ...] = ()) -> DataFrame:
    """One row per (source, code), and per value of the columns `apart`; of several categories for a code the smallest stays."""
    medical = ems.select(
        F.col("FINAL_CALL_TYPE").alias("type_code"),
        F.lit(EMS).alias("source"),
        F.lit(EMS_CATEGORY).alias("category"),
        *apart,
    )
    graded = fire.select(
        F.col("INCIDENT_CLASSIFICATION").alias("type_code"),
        F.lit(FIRE).alias("source"),
        F.col("INCIDENT_CLASSIFICATION_GROUP").alias("category"),
        *apart,
    )
    return smallest_category(medical.unionByName(graded).dropna(), apart)


def smallest_category(rows: DataFrame, apart: tuple[str, ...] = ()) -> DataFrame:
    return rows.groupBy("type_code", "source", *apart).agg(F.min("category").alias("category"))


def dim_incident_type(ems: DataFrame, fire: DataFrame) -> DataFrame:
    return dense_key(type_rows(ems, fire), "incident_type_key", TYPE_ORDER)


def hour_rows(weather: DataFrame) -> DataFrame:
    """One row per hour, extremes flagged. A repeated hour keeps its smallest reading; one that cannot be read is dropped."""
    at = parse_iso(F.col("time").cast("string"))
    hours = (
        weather.select(
            date_key(at).alias("date_key"),
            F.hour(at).alias("hour"),
            F.struct(
                to_double(F.col("temperature_2m")).alias("temp_f"),
                to_double(F.col("precipitation")).alias("precip_in"),
                to_double(F.col("windspeed_10m")).alias("wind_mph"),
                to_long(F.col("weathercode")).cast("int").alias("weather_code"),
            ).alias("reading"),
        )
        .filter(F.col("date_key").isNotNull())
        .groupBy("date_key", "hour")
        .agg(F.min("reading").alias("reading"))
        .select("date_key", "hour", "reading.*")
    )
    return hours.withColumns(
        {
            "is_raining": flag(F.col("precip_in") > 0),
            "is_hot": flag(F.col("temp_f") > HOT_ABOVE),
            "is_cold": flag(F.col("temp_f") < COLD_BELOW),
        }
    )


def dim_weather(weather: DataFrame) -> DataFrame:
    return dense_key(hour_rows(weather), "weather_key", HOUR_ORDER)


def code_dims(frames: list[tuple[DataFrame, list[tuple[str, str, str]]]]) -> dict[str, DataFrame]:
    """Conformed code lists, one table per code column, from a single scan per frame.

    All codes are numbered in one run; a table's own numbering starts where its codes start.
    """
    parts, built = [], []
    for df, specs in frames:
        have = [s for s in specs if s[2] in df.columns]
        built += have
        if have:
            tagged = [
                F.struct(F.lit(table).alias("table"), conform_text(F.col(column)).alias("code"))
                for table, _, column in have
            ]
            parts.append(df.select(F.inline(F.array(*tagged))))
    if not parts:
        return {}
    codes = dense_key(_union(parts).dropna().distinct(), "position", ["table", "code"])
    first = {r["table"]: r["start"] for r in codes.groupBy("table").agg(F.min("position").alias("start")).collect()}
    return {
        table: codes.filter(F.col("table") == table).select(
            (F.col("position") - (first.get(table, 1) - 1)).cast("bigint").alias(key), F.col("code").alias(column)
        )
        for table, key, column in built
    }


def code_dim(df: DataFrame, column: str, key: str) -> DataFrame:
    """A single conformed code list."""
    codes = df.select(conform_text(F.col(column)).alias(column)).dropna().distinct()
    return dense_key(codes, key, [column])


def area_mode(df: DataFrame, area: str, value: str) -> DataFrame:
    """The most frequent value per area, the smaller value on a tie.

    Counts are taken per (area, value) first; the best of them is an ordinary aggregate, so a big
    area is never sorted in one task.
    """
    counts = df.dropna(subset=[area, value]).groupBy(area, value).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("value")))
    return counts.groupBy(area).agg(best.alias("best")).select(area, F.col("best.value").alias(value))


def area_mapping(ems: DataFrame) -> DataFrame:
    """ZIPCODE to its most frequent borough."""
    conformed = ems.select("ZIPCODE", F.col("BOROUGH_NORM").alias("BOROUGH"))
    return area_mode(conformed, "ZIPCODE", "BOROUGH")
