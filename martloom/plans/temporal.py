"""Temporal marts over a combined fact.

Inputs use fact columns: hour, nb_interventions, travel_time, dispatch_time, incident_type_key,
weather_key. Facts are folded to their keys before a dimension is joined, so what meets the
dimension is at most (keys x hours) rows, whatever the size of the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.bins import bin_edges, bin_floor, bin_top
from martloom.functions.numbers import zero_if_null
from martloom.operators.exact import group_means
from martloom.operators.fits import linear_fit
from martloom.storage import store

# Heatmap categories, shift changes, temperature bins (lo, hi, width) in Fahrenheit.
TOP_CATEGORIES = 10
SHIFT_CHANGES = (9, 18)
TEMP_BINS = (0, 105, 5)

HOURS = list(range(24))


def total(col: str) -> Column:
    """Sum that is 0, not NULL, when nothing is summed."""
    return zero_if_null(F.sum(col))


def volume_vs_speed(fact: DataFrame, exact: bool = False) -> DataFrame:
    """Per hour the volume and the mean travel time; `exact` means do not depend on the order of rows."""
    timed = fact.filter(F.col("hour").isNotNull())
    folded = group_means(timed, ["hour"], {"travel_time": "travel_time"}, {"n": "nb_interventions"}, exact)
    return folded.select("hour", zero_if_null(F.col("n")).alias("nb_interventions"), "travel_time")


def volume_by_category(fact: DataFrame, types: DataFrame) -> DataFrame:
    """(category, hour, n, rows): the fact folded to its type keys, then named."""
    folded = fact.groupBy("incident_type_key", "hour").agg(
        F.sum("nb_interventions").alias("n"), F.count("*").alias("rows")
    )
    named = folded.join(types.select("incident_type_key", "category"), "incident_type_key")
    return named.groupBy("category", "hour").agg(total("n").alias("n"), F.sum("rows").alias("rows"))


def risk_heatmap(fact: DataFrame, types: DataFrame, top: int | None = TOP_CATEGORIES) -> DataFrame:
    """(hour, category, n) for the categories with most rows, empty cells 0; `top=None` for all.

    The counts, at most 24 rows per category, are stored: they are used three times and the fact
    is to be read once.
    """
    counts = store(volume_by_category(fact, types).filter(F.col("category").isNotNull()), "category_hours")
    if top is not None:
        ranked = counts.groupBy("category").agg(F.sum("rows").alias("rows"))
        best = ranked.orderBy(F.desc("rows"), F.asc("category")).limit(top)
        counts = counts.join(best.select("category"), "category", "left_semi")
    wide = heatmap_wide(counts)
    long = wide.unpivot("category", [str(h) for h in HOURS], "hour", "n").withColumn("hour", F.col("hour").cast("int"))
    seen = counts.filter(F.col("hour").isNotNull()).select("hour").distinct()
    return long.join(seen, "hour", "left_semi").select("hour", "category", "n")


def heatmap_wide(counts: DataFrame) -> DataFrame:
    """One row per category, one column per hour. The hours are given, so no extra job finds them."""
    return counts.groupBy("category").pivot("hour", HOURS).agg(F.sum("n")).fillna(0)


def shift_change(fact: DataFrame, exact: bool = False) -> DataFrame:
    """Per hour the mean dispatch time, shift changes marked."""
    timed = fact.filter(F.col("hour").isNotNull())
    folded = group_means(timed, ["hour"], {"dispatch_time": "dispatch_time"}, exact=exact)
    return folded.withColumn("is_shift_change", F.col("hour").isin(*SHIFT_CHANGES).cast("int"))


def volume_by_weather(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """(temp_f, n): the fact folded to its weather keys, then given the temperature."""
    folded = fact.groupBy("weather_key").agg(F.sum("nb_interventions").alias("n"))
    return folded.join(weather.select("weather_key", "temp_f"), "weather_key").select("temp_f", "n")


def temp_volume(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Volume per right-closed temperature bin, every bin present."""
    lo, hi, width = TEMP_BINS
    inside = volume_by_weather(fact, weather).filter((F.col("temp_f") > lo) & (F.col("temp_f") <= hi))
    filled = inside.groupBy(bin_top(F.col("temp_f"), width).alias("top")).agg(F.sum("n").alias("n"))
    tops = fact.sparkSession.range(lo + width, hi + width, width).withColumnRenamed("id", "bin_top")
    return tops.join(filled, tops.bin_top == filled.top, "left").select(
        *bin_edges(F.col("bin_top"), width), zero_if_null(F.col("n")).alias("nb_interventions")
    )


def temp_trend(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Line through the bins of `temp_volume`, empty ones included."""
    return linear_fit(temp_volume(fact, weather), "bin_mid", "nb_interventions")


def temp_volume_floor(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Variant: left-closed bins without limits, only those that occur."""
    width = TEMP_BINS[2]
    counts = volume_by_weather(fact, weather).filter(F.col("temp_f").isNotNull())
    return counts.groupBy(bin_floor(F.col("temp_f"), width).alias("temp_bin")).agg(
        total("n").alias("nb_interventions")
    )


def temp_trend_floor(fact: DataFrame, weather: DataFrame) -> DataFrame:
    return linear_fit(temp_volume_floor(fact, weather), "temp_bin", "nb_interventions")
