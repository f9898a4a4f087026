"""Raw files: CSV as text columns, weather as CSV or column-oriented JSON, areas as GeoJSON."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.text import null_tokens_in
from martloom.sources.records import CSV, read_csv

WEATHER_SCHEMA = (
    "time STRING, temperature_2m STRING, precipitation STRING, weathercode STRING, windspeed_10m STRING"
)

_HOURLY_JSON = (
    "hourly STRUCT<time: ARRAY<STRING>, temperature_2m: ARRAY<DOUBLE>, precipitation: ARRAY<DOUBLE>, "
    "weathercode: ARRAY<INT>, windspeed_10m: ARRAY<DOUBLE>>"
)

_FEATURE = "STRUCT<properties: MAP<STRING, STRING>, geometry: STRUCT<type: STRING, coordinates: STRING>>"
_POLYGON = "ARRAY<ARRAY<ARRAY<DOUBLE>>>"


def read_text_table(
    spark: SparkSession, path: str, columns: list[str] | None = None, line_breaks: bool = True
) -> DataFrame:
    """A CSV with header, every column STRING and null tokens as NULL.

    Nothing is inferred; `columns` must all be present. A file is read in splits by many tasks. Quoted
    fields may hold line breaks, for which it is read twice; without `line_breaks`, for files known to have
    none, once.
    """
    raw = read_csv(spark, path) if line_breaks else spark.read.options(**CSV, header=True).csv(path)
    if columns is not None:
        missing = [c for c in columns if c not in raw.columns]
        if missing:
            raise ValueError(f"columns not found in {path}: {missing}")
        raw = raw.select(*[F.col(f"`{c}`") for c in columns])
    return nulls_from_tokens(raw)


def nulls_from_tokens(raw: DataFrame) -> DataFrame:
    return raw.select(*[null_tokens_in(c).alias(c) for c in raw.columns])


def read_keyed_csv(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """A CSV export with the named columns cast, all others left as text."""
    table = read_text_table(spark, path)
    return table.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()})


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Hourly weather CSV; the file is optional and an absent one gives an empty frame."""
    try:
        table = read_text_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], WEATHER_SCHEMA)
    return table


def flatten_hourly(responses: DataFrame, column: str = "hourly") -> DataFrame:
    """Column-oriented series (a struct of equally long arrays) to one row per entry."""
    fields = responses.schema[column].dataType.fieldNames()
    return responses.select(F.inline(F.arrays_zip(*[F.col(f"{column}.{f}").alias(f) for f in fields])))


def read_weather_json(spark: SparkSession, path: str) -> DataFrame:
    """Saved weather responses, one JSON document per file."""
    return flatten_hourly(spark.read.schema(_HOURLY_JSON).option("multiLine", True).json(path))


def read_areas(spark: SparkSession, path: str, code: str = "MODZCTA", one_per_line: bool = False) -> DataFrame:
    """GeoJSON polygons as (area_code, parts), parts in the nesting the geometry functions take.

    A feature collection is one JSON document. `one_per_line` reads newline-delimited features,
    the splittable form for large area sets.
    """
    if one_per_line:
        fields = "properties MAP<STRING, STRING>, geometry STRUCT<type: STRING, coordinates: STRING>"
        features = spark.read.schema(fields).json(path)
    else:
        collection = spark.read.schema(f"features ARRAY<{_FEATURE}>").option("multiLine", True).json(path)
        features = collection.select(F.inline("features"))
    text = F.col("geometry.coordinates")
    parts = F.when(F.col("geometry.type") == "MultiPolygon", F.from_json(text, f"ARRAY<{_POLYGON}>")).when(
        F.col("geometry.type") == "Polygon", F.array(F.from_json(text, _POLYGON))
    )
    return features.select(F.col("properties").getItem(code).alias("area_code"), parts.alias("parts"))
