"""The two-fact model kept up to date by years, without building the rest again.

Beside its tables the model folder holds, per year, what the rows of that year contribute to each dimension (`part_...`,
distinct values only), and a registry of keys per dimension (`keys_...`). A refresh replaces the years it is given in
the facts and contributions, folds the contributions of all years to the dimensions, and takes keys from the
registries. So facts of other years are neither read nor written, and their keys hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.operators.keys import kept_keys
from martloom.plans import dimensions as dims
from martloom.plans import facts
from martloom.plans.staging import EMS_NEEDS, FIRE_NEEDS, needed, stage_ems, stage_fire
from martloom.sources.raw import read_text_table, read_weather
from martloom.sources.tables import replace_partitions, write_table
from martloom.storage import kept_until_done, store

YEAR = "year"
#: The year of rows whose time cannot be read.
NO_YEAR = 0


def year_of(date_key: Column) -> Column:
    return F.coalesce((date_key / 10_000).cast("int"), F.lit(NO_YEAR))


def _of_years(staged: DataFrame, years: list[int]) -> DataFrame:
    """Only rows of these years. A filter is computed again from the raw text below, so it reads the time once."""
    year = F.coalesce(F.year("INCIDENT_DATETIME"), F.lit(NO_YEAR))
    return staged.filter(year.isin(years)).withColumn(YEAR, year_of(F.col("DATE_KEY")))


def _contributions(ems: DataFrame, fire: DataFrame, weather: DataFrame) -> dict[str, DataFrame]:
    """What each year adds to the dimensions. A day or hour lies in one year; places and types may come in several."""
    days = dims.dim_time([ems, fire]).select("date", year_of(F.col("date_key")).alias(YEAR))
    return {
        "day": days,
        "location": dims.location_rows([ems, fire], (YEAR,)),
        "type": dims.type_rows(ems, fire, (YEAR,)),
        "hour": dims.hour_rows(weather).withColumn(YEAR, year_of(F.col("date_key"))),
    }


def refresh_galaxy(
    ems: DataFrame, fire: DataFrame, sites: DataFrame, weather: DataFrame, folder: str, years: list[int]
) -> None:
    """Bring `years` of the model in `folder` to what the raw frames hold of them; the first call creates it.

    The frames may hold other years too; those rows are left aside. A year that they hold nothing of becomes empty. NO_YEAR
    stands for rows without a readable time. The site list has no years and is taken as given. Afterwards the tables
    equal a build of all years at once but for the numbers of keys. A call that failed may be repeated. A fact without
    rows in any year has no files, so Spark needs a schema to read it.
    """
    if not years:
        raise ValueError("name at least one year")
    spark = ems.sparkSession
    ems = store(_of_years(needed(stage_ems(ems), EMS_NEEDS), years), "staged_ems")
    fire = store(_of_years(needed(stage_fire(fire), FIRE_NEEDS), years), "staged_fire")

    parts = {}
    for name, rows in _contributions(ems, fire, weather).items():
        replace_partitions(store(rows, f"part_{name}"), folder, f"part_{name}", YEAR, years)
        columns = [f for f in rows.schema if f.name != YEAR]
        parts[name] = spark.read.schema(StructType([*columns, rows.schema[YEAR]])).parquet(f"{folder}/part_{name}").drop(YEAR)

    def keyed(rows: DataFrame, key: str, natural: list[str]) -> DataFrame:
        return store(kept_keys(rows, f"{folder}/keys_{key}", key, natural), key)

    site = dims.site_rows(sites)
    tables = {
        "Dim_Time": dims.dim_time([parts["day"]], ["date"]),
        "Dim_Location": keyed(parts["location"].distinct(), "location_key", dims.LOCATION_ORDER),
        "Dim_Firehouse": keyed(site, "firehouse_key", site.columns),
        "Dim_IncidentType": keyed(dims.smallest_category(parts["type"]), "incident_type_key", dims.TYPE_ORDER),
        "Dim_Weather": keyed(parts["hour"], "weather_key", dims.HOUR_ORDER),
    }
    for name, df in tables.items():
        write_table(df, folder, name)
    shared = [tables[n] for n in ("Dim_Location", "Dim_IncidentType", "Dim_Weather")]
    built = {"Fact_Incidents_EMS": facts.fact_ems(ems, *shared), "Fact_Incidents_Fire": facts.fact_fire(fire, *shared)}
    for name, df in built.items():
        replace_partitions(store(df.withColumn(YEAR, year_of(F.col("date_key"))), name), folder, name, YEAR, years)


def run_refresh(spark: SparkSession, raw_folder: str, out_folder: str, years: list[int]) -> None:
    """As `refresh_galaxy`, from raw files like those of `run_galaxy`."""
    raw = [read_text_table(spark, f"{raw_folder}/{name}.csv") for name in ("EMS", "FIRE", "Firehouse")]
    with kept_until_done(spark):
        refresh_galaxy(*raw, read_weather(spark, f"{raw_folder}/weather_nyc.csv"), out_folder, years)
