"""Refreshing some years of the model, against a build of all of it."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom.operators.keys import kept_keys
from martloom.plans import refresh
from martloom.plans.models import build_galaxy
from martloom.plans.refresh import NO_YEAR, refresh_galaxy
from martloom.plans.staging import stage_ems
from martloom.sources.tables import read_table

EMS_HEAD = ["CAD_INCIDENT_ID", "INCIDENT_DATETIME", "ZIPCODE", "BOROUGH", "INITIAL_CALL_TYPE", "FINAL_CALL_TYPE", "INCIDENT_RESPONSE_SECONDS_QY"]
FIRE_HEAD = ["STARFIRE_INCIDENT_ID", "INCIDENT_DATETIME", "ZIPCODE", "INCIDENT_BOROUGH", "INCIDENT_CLASSIFICATION", "INCIDENT_CLASSIFICATION_GROUP",
             "ENGINES_ASSIGNED_QUANTITY", "LADDERS_ASSIGNED_QUANTITY", "OTHER_UNITS_ASSIGNED_QUANTITY", "INCIDENT_RESPONSE_SECONDS_QY"]
SITE_HEAD = ["FacilityName", "FacilityAddress", "Borough", "Postcode", "Latitude", "Longitude"]
WX_HEAD = ["time", "temperature_2m", "precipitation", "weathercode", "windspeed_10m"]
DIMS = {"Dim_Location": "location_key", "Dim_IncidentType": "incident_type_key", "Dim_Weather": "weather_key", "Dim_Firehouse": "firehouse_key"}
FACTS = ["Fact_Incidents_EMS", "Fact_Incidents_Fire"]


def ems(i, day, zipcode, kind, seconds="10"):
    return [str(i), f"{day} 03:04:05 PM", zipcode, "QUEENS", kind, kind, seconds]


def fire(i, day, zipcode, kind, group):
    return [f"F{i}", f"{day} 03:30:00 PM", zipcode, "BRONX", kind, group, "1", "2", "3", "40"]


BEFORE = {
    "ems": [ems(1, "01/02/2021", "10001", "SICK"), ems(2, "05/02/2022", "10002", "INJURY"), ems(3, "nothing", "10003", "SICK"),
            ems(4, "05/03/2022", "", "FALL"), ems(4, "05/03/2022", "", "FALL")],
    "fire": [fire(1, "01/02/2021", "10002", "Smoke", "Structural"), fire(2, "05/02/2022", "10009", "Smoke", "Alarms"),
             fire(3, "05/02/2022", "10009", "Gas", "Other"), fire(4, "01/02/2023", "10001", "Odour", "Other")],
    "weather": [["2021-01-02T15:00", "31.9", "0.0", "3", "4"], ["2022-05-02T15:00", "70", "0.1", "3", "4"]],
}
# of 2022 a place, a type and a category are gone, others are new, and an hour was corrected; 2023 is gone altogether
AFTER = {
    "ems": [BEFORE["ems"][0], ems(2, "05/02/2022", "10000", "ASTHMA", "77"), BEFORE["ems"][2], ems(9, "06/01/2022", "10002", "FALL")],
    "fire": [BEFORE["fire"][0], fire(2, "05/02/2022", "10001", "Smoke", "Zone"), fire(7, "07/02/2022", "10011", "Flood", "Other")],
    "weather": [BEFORE["weather"][0], ["2022-05-02T15:00", "95", "0.0", "3", "4"], ["2022-06-01T15:00", "60", "", "", ""]],
}


def frames(spark, rows):
    heads = {"ems": EMS_HEAD, "fire": FIRE_HEAD, "weather": WX_HEAD}
    made = {n: spark.createDataFrame(rows[n], " STRING, ".join(heads[n]) + " STRING") for n in heads}
    sites = spark.createDataFrame([["Engine 1", "1 St", "Bronx", "10001", "0.5", "0.5"]], " STRING, ".join(SITE_HEAD) + " STRING")
    return made["ems"], made["fire"], sites, made["weather"]


def said(tables):
    """The facts with natural columns for keys, and the dimensions without them."""
    out = {n: sorted(map(tuple, tables[n].drop(k).collect()), key=repr) for n, k in DIMS.items()}
    out["Dim_Time"] = sorted(map(tuple, tables["Dim_Time"].collect()), key=repr)
    for name in FACTS:
        fact = tables[name].drop("year")
        for dim, key in list(DIMS.items())[:3]:
            fact = fact.join(tables[dim], key, "left").drop(key)
        out[name] = sorted(map(tuple, fact.collect()), key=repr)
    return out


def stored(spark, folder):
    return {n: read_table(spark, folder, n) for n in [*DIMS, *FACTS, "Dim_Time"]}


def files(folder, *years):
    found = (p for n in FACTS for y in years for p in Path(folder, n, f"year={y}").glob("*.parquet"))
    return {(str(p), p.stat().st_mtime_ns) for p in found}


def keys_of(tables):
    natural = {"Dim_Location": ["borough", "zipcode"], "Dim_IncidentType": ["source", "type_code"], "Dim_Weather": ["date_key", "hour"]}
    return {(n, *r[1:]): r[0] for n, by in natural.items() for r in tables[n].select(DIMS[n], *by).collect()}


def test_a_refreshed_year_equals_a_full_build(spark, tmp_path):
    folder = str(tmp_path)
    refresh_galaxy(*frames(spark, BEFORE), folder, [2021, 2022, 2023, NO_YEAR])
    first = said(build_galaxy(*frames(spark, BEFORE)))
    assert said(stored(spark, folder)) == first
    untouched, before = files(folder, 2021, NO_YEAR), keys_of(stored(spark, folder))
    assert untouched and files(folder, 2023)

    whole = said(build_galaxy(*frames(spark, AFTER)))
    for _ in range(2):  # a repeated call changes nothing
        refresh_galaxy(*frames(spark, AFTER), folder, [2022, 2023])
        assert said(stored(spark, folder)) == whole
        assert files(folder, 2021, NO_YEAR) == untouched and not files(folder, 2023)
        after = keys_of(stored(spark, folder))
        assert all(before[k] == v for k, v in after.items() if k in before)
        new = [v for k, v in after.items() if k not in before and k[0] == "Dim_Location"]
        assert new and min(new) > max(v for k, v in before.items() if k[0] == "Dim_Location")


def test_years_without_rows_and_no_years(spark, tmp_path):
    refresh_galaxy(*frames(spark, BEFORE), str(tmp_path), [1999])
    assert all(read_table(spark, str(tmp_path), t).count() == 0 for t in ("Dim_Location", "Dim_Weather", "Dim_Time"))
    with pytest.raises(ValueError):
        refresh_galaxy(*frames(spark, BEFORE), str(tmp_path), [])


def test_a_registry_keeps_and_continues_keys(spark, tmp_path):
    path = str(tmp_path / "keys")

    def run(*names):
        rows = spark.createDataFrame([(n, 1) for n in names], "name STRING, v INT")
        return {r.name: r.k for r in kept_keys(rows, path, "k", ["name"]).collect()}

    assert run("b", "d", None) == {"b": 1, "d": 2, None: 3}
    assert run("a", "d", None) == {"a": 4, "d": 2, None: 3}
    assert run() == {} and run("a", "b", "c") == {"a": 4, "b": 1, "c": 5}
    assert spark.read.parquet(path).agg(F.count_distinct("k"), F.count("*")).first()[:] == (5, 5)


def test_a_filter_of_years_reads_the_time_once(spark):
    """The optimizer computes the filter from the raw text, beside the columns that are kept."""
    text = F.col("id").cast("string")
    raw = spark.range(3).select(*[text.alias(c) for c in ("INCIDENT_DATETIME", "ZIPCODE", "BOROUGH")])
    plan = refresh._of_years(stage_ems(raw), [2024])._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert len(filters) == 1 and filters[0].count("gettimestamp") == 1
