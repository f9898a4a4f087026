"""The two whole models, from raw frames to named tables, and the runners around them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martloom.plans import dimensions as dims
from martloom.plans import facts
from martloom.plans.quality import counted
from martloom.plans.staging import EMS_NEEDS, FIRE_NEEDS, needed, stage_ems, stage_fire
from martloom.sources.raw import read_text_table, read_weather
from martloom.sources.tables import write_tables
from martloom.storage import kept_until_done, store


def build_galaxy(ems: DataFrame, fire: DataFrame, sites: DataFrame, weather: DataFrame) -> dict[str, DataFrame]:
    """Two facts over shared dimensions.

    Staging is stored, so raw text is parsed once and each dimension reads only its columns.
    """
    ems = store(needed(stage_ems(ems), EMS_NEEDS), "staged_ems")
    fire = store(needed(stage_fire(fire), FIRE_NEEDS), "staged_fire")
    location = dims.dim_location([ems, fire])
    types = dims.dim_incident_type(ems, fire)
    hours = dims.dim_weather(weather)
    return {
        "Dim_Time": dims.dim_time([ems, fire]),
        "Dim_Location": location,
        "Dim_Firehouse": dims.dim_site(sites),
        "Dim_IncidentType": types,
        "Dim_Weather": hours,
        "Fact_Incidents_EMS": facts.fact_ems(ems, location, types, hours),
        "Fact_Incidents_Fire": facts.fact_fire(fire, location, types, hours),
    }


def build_star(ems: DataFrame, fire: DataFrame, sites: DataFrame) -> dict[str, DataFrame]:
    """The wider model: masked measures, code dimensions, indicator flags and the area bridge."""
    ems = store(stage_ems(ems), "staged_ems")
    fire = store(stage_fire(fire), "staged_fire")
    location = dims.dim_location_wide([ems, fire])
    codes = dims.code_dims([(ems, dims.EMS_CODE_DIMS), (fire, dims.FIRE_CODE_DIMS)])
    site = dims.dim_site_wide(sites)
    return {
        "dim_time": dims.dim_time_wide([ems, fire]),
        "dim_location": location,
        "dim_firehouse": site,
        "bridge_zip_firehouse": dims.bridge_area_site(site),
        "fact_incident_ems": facts.star_fact_ems(ems, location, codes),
        "fact_incident_fire": facts.star_fact_fire(fire, location, codes),
        **codes,
    }


def _counting(frames: dict[str, DataFrame]) -> tuple[list[DataFrame], Callable[[], dict[str, int]]]:
    """The frames, and a function that tells how many rows of each were read once they have been."""
    observed = {name: counted(df, f"rows of {name}") for name, df in frames.items()}
    return [df for df, _ in observed.values()], lambda: {name: seen.get["rows"] for name, (_, seen) in observed.items()}


def run_galaxy(spark: SparkSession, raw_folder: str, out_folder: str) -> dict[str, int]:
    """Build from raw files, write all tables and clear what was stored on the way; returns rows read per file.

    The weather file is optional and is counted when it is there.
    """
    raw = {name: read_text_table(spark, f"{raw_folder}/{name}.csv") for name in ("EMS", "FIRE", "Firehouse")}
    frames, counts = _counting(raw | {"weather_nyc": read_weather(spark, f"{raw_folder}/weather_nyc.csv")})
    with kept_until_done(spark):
        write_tables(build_galaxy(*frames), out_folder)
    return counts()


def run_star(spark: SparkSession, raw_folder: str, out_folder: str) -> dict[str, int]:
    """As `run_galaxy`, for the wider model, which has no weather."""
    frames, counts = _counting({n: read_text_table(spark, f"{raw_folder}/{n}.csv") for n in ("EMS", "FIRE", "Firehouse")})
    with kept_until_done(spark):
        write_tables(build_star(*frames), out_folder)
    return counts()
