"""The two models over raw files that hold every awkward case."""

import csv

import pytest
from pyspark.sql import functions as F

from martloom.plans import dimensions as dims
from martloom.plans import facts, geographic, multivariate, operational, quality, temporal
from martloom.plans.models import build_galaxy, run_galaxy, run_star
from martloom.plans.staging import stage_ems, stage_fire
from martloom.sources.raw import read_text_table, read_weather
from martloom.sources.tables import read_table

EMS_HEAD = ["CAD_INCIDENT_ID", "INCIDENT_DATETIME", "FIRST_ON_SCENE_DATETIME", "ZIPCODE", "BOROUGH", "POLICEPRECINCT",
            "INITIAL_CALL_TYPE", "FINAL_CALL_TYPE", "INITIAL_SEVERITY_LEVEL_CODE", "DISPATCH_RESPONSE_SECONDS_QY",
            "INCIDENT_RESPONSE_SECONDS_QY", "INCIDENT_TRAVEL_TM_SECONDS_QY", "HELD_INDICATOR"]
EMS = [
    ["1", "01/02/2022 03:04:05 PM", "01/03/2022 12:10:00 AM", "10001", "\tRichmond / Staten Island ", "5", "SICK", "SICK", "2", "10", "100", "90", "Y"],
    ["2", "1/2/2022 3:59:59 PM", "", "10001.0", "RICHMOND", "5", "SICK", "INJURY", "3", "-1", "50", "999", "false"],
    ["3", "03/13/2022 02:30:00 AM", "", " 10001 ", "NA", "", "SICK", "INJURY", "2", "999", "NA", "0", "x"],
    ["4", "02/30/2022 01:00:00 AM", "", "10001", "null", "5", "", "INJURY", "", "998.9", "70", "1,000", "N"],
    ["5", "06/30/2022 12:00:00 AM", "", "abc", "Queens", "7", "INJURY", "sick ", "2", "20", "80", "60", "TRUE"],
    ["", "07/01/2022 12:00:00 PM", "", "", "QUEENS", "7", "INJURY", "", "2", "30", "90", "60", "0"],
]
FIRE_HEAD = ["STARFIRE_INCIDENT_ID", "INCIDENT_DATETIME", "ZIPCODE", "INCIDENT_BOROUGH", "POLICEPRECINCT", "INCIDENT_CLASSIFICATION",
             "INCIDENT_CLASSIFICATION_GROUP", "ENGINES_ASSIGNED_QUANTITY", "LADDERS_ASSIGNED_QUANTITY", "OTHER_UNITS_ASSIGNED_QUANTITY",
             "DISPATCH_RESPONSE_SECONDS_QY", "INCIDENT_RESPONSE_SECONDS_QY", "INCIDENT_TRAVEL_TM_SECONDS_QY", "HIGHEST_ALARM_LEVEL"]
FIRE = [
    ["F1", "01/02/2022 03:30:00 PM", "10001", "", "5", "Smoke", "Structural", "2", "1", "", "40", "240", "200", "First"],
    ["F2", "01/02/2022 04:00:00 PM", "10002.0", "BRONX", "", "Smoke", "Nonstructural", "1", "", "1", "60", "360", "300", ""],
    ["F3", "01/02/2022 04:30:00 PM", "10002", "bronx", "", "Alarm", "False", "3", "1", "0", "", "", "", "All"],
    ["F4", "bad", "10003", "BRONX", "9", "", "False", "x", "0", "0", "5", "6", "7", ""],
]
SITE_HEAD = ["FacilityName", "FacilityAddress", "Borough", "Postcode", "Latitude", "Longitude", "Community Board"]
SITES = [
    ["Engine 1", "1 St", "Manhattan", "10001", "0.5", "0.5", "1"],
    ["Engine 2", "2 St", "richmond", "", "0.5", "0.5", "2"],
    ["Engine 3", "3 St", "Bronx", "10002.0", "0.5", "5.5", "3"],
    ["Engine 1", "1 St", "Manhattan", "10001", "0.5", "0.5", "1"],
    ["Engine 4", "4 St", "Bronx", "10003", "", "", "3"],
]
WX_HEAD = ["time", "temperature_2m", "precipitation", "weathercode", "windspeed_10m"]
WX = [
    ["2022-01-02T15:00", "31.9", "0.0", "3", "4.5"],
    ["2022-01-02T15:00", "33.0", "0.1", "3", "4.5"],
    ["2022-01-02T16:00", "91.0", "0.2", "61", "9"],
    ["2022-03-13T02:00", "", "", "", ""],
]


def save(folder, name, head, rows):
    with open(folder / name, "w", newline="") as f:
        csv.writer(f).writerows([head, *rows])


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    save(folder, "EMS.csv", EMS_HEAD, EMS)
    save(folder, "FIRE.csv", FIRE_HEAD, FIRE)
    save(folder, "Firehouse.csv", SITE_HEAD, SITES)
    save(folder, "weather_nyc.csv", WX_HEAD, WX)
    return folder


@pytest.fixture(scope="module")
def galaxy(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("galaxy"))
    read = run_galaxy(spark, str(raw), out)
    assert (read["EMS"], read["FIRE"]) == (len(EMS), len(FIRE)) and set(read) == {"EMS", "FIRE", "Firehouse", "weather_nyc"}
    names = ["Dim_Time", "Dim_Location", "Dim_Firehouse", "Dim_IncidentType", "Dim_Weather", "Fact_Incidents_EMS", "Fact_Incidents_Fire"]
    return {n: read_table(spark, out, n) for n in names}


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_time_dimension(galaxy):
    assert sorted(by(galaxy["Dim_Time"], "date_key")) == [20220102, 20220313, 20220630, 20220701]


def test_location_dimension(galaxy):
    rows = [(r["location_key"], r["borough"], r["zipcode"]) for r in galaxy["Dim_Location"].orderBy("location_key").collect()]
    assert rows == [(1, "BRONX", 10002), (2, "BRONX", 10003), (3, "STATEN ISLAND", 10001), (4, None, 10001)]


def test_site_dimension(galaxy):
    rows = galaxy["Dim_Firehouse"].orderBy("firehouse_key").collect()
    assert [r["firehouse_name"] for r in rows] == ["Engine 1", "Engine 2", "Engine 3", "Engine 4"]
    assert [r["borough"] for r in rows] == ["MANHATTAN", "STATEN ISLAND", "BRONX", "BRONX"]
    assert [r["zipcode"] for r in rows] == [10001, None, 10002, 10003]
    assert rows[3]["Latitude"] is None


def test_incident_types_keep_raw_codes_and_the_smallest_category(galaxy):
    rows = [(r["source"], r["type_code"], r["category"]) for r in galaxy["Dim_IncidentType"].orderBy("incident_type_key").collect()]
    assert rows == [("EMS", "INJURY", "Medical"), ("EMS", "SICK", "Medical"), ("EMS", "sick ", "Medical"),
                    ("FIRE", "Alarm", "False"), ("FIRE", "Smoke", "Nonstructural")]


def test_weather_dimension(galaxy):
    rows = galaxy["Dim_Weather"].orderBy("weather_key").collect()
    assert [(r["date_key"], r["hour"], r["temp_f"]) for r in rows] == [(20220102, 15, 31.9), (20220102, 16, 91.0), (20220313, 2, None)]
    assert [(r["is_raining"], r["is_hot"], r["is_cold"]) for r in rows] == [(0, 0, 1), (1, 1, 0), (0, 0, 0)]


def test_ems_fact(galaxy):
    rows = by(galaxy["Fact_Incidents_EMS"], "incident_id")
    assert galaxy["Fact_Incidents_EMS"].count() == len(EMS)
    assert [rows[i]["location_key"] for i in (1, 2, 3, 4, 5, None)] == [3, 3, 4, 4, None, None]
    assert [rows[i]["weather_key"] for i in (1, 2, 3, 4, 5)] == [1, 1, 3, None, None]
    assert [rows[i]["dispatch_time"] for i in (1, 2, 3, 4)] == [10.0, -1.0, 999.0, 998.9]
    assert (rows[4]["date_key"], rows[4]["hour"], rows[4]["travel_time"]) == (None, None, None)
    assert rows[3]["response_time"] is None and rows[4]["initial_call_type"] is None
    assert rows[5]["final_call_type"] == "sick "


def test_fire_fact(galaxy):
    rows = by(galaxy["Fact_Incidents_Fire"], "incident_id")
    assert [rows[f"F{i}"]["total_units"] for i in (1, 2, 3, 4)] == [3, 2, 4, 0]
    assert [rows[f"F{i}"]["location_key"] for i in (1, 2, 3, 4)] == [4, 1, 1, 2]
    assert [rows[f"F{i}"]["incident_type_key"] for i in (1, 2, 3, 4)] == [5, 5, 4, None]
    assert [rows[f"F{i}"]["weather_key"] for i in (1, 2, 3, 4)] == [1, 2, 2, None]
    assert rows["F1"]["total_duration"] is None


def test_foreign_keys_resolve(galaxy):
    pairs = [("location_key", "Dim_Location"), ("incident_type_key", "Dim_IncidentType"), ("weather_key", "Dim_Weather"), ("date_key", "Dim_Time")]
    for fact in ("Fact_Incidents_EMS", "Fact_Incidents_Fire"):
        for key, dim in pairs:
            assert quality.orphan_keys(galaxy[fact], galaxy[dim], key, key).count() == 0


def test_row_order_and_splits_do_not_matter(spark, raw, galaxy):
    def again(name):
        return read_text_table(spark, str(raw / name)).orderBy(F.rand(7)).repartition(5)

    rebuilt = build_galaxy(again("EMS.csv"), again("FIRE.csv"), again("Firehouse.csv"), again("weather_nyc.csv"))
    for name, df in galaxy.items():
        assert sorted(map(repr, rebuilt[name].collect())) == sorted(map(repr, df.collect())), name


def test_without_weather(spark, raw, tmp_path):
    def read(name):
        return read_text_table(spark, str(raw / name))

    missing = read_weather(spark, str(tmp_path / "none.csv"))
    tables = build_galaxy(read("EMS.csv"), read("FIRE.csv"), read("Firehouse.csv"), missing)
    assert tables["Dim_Weather"].count() == 0
    assert tables["Fact_Incidents_EMS"].filter("weather_key is not null").count() == 0
    bins = temporal.temp_volume(tables["Fact_Incidents_EMS"], tables["Dim_Weather"]).collect()
    assert len(bins) == 21 and {r["nb_interventions"] for r in bins} == {0}


def test_star(spark, raw, tmp_path):
    run_star(spark, str(raw), str(tmp_path))

    def read(name):
        return read_table(spark, str(tmp_path), name)

    days = by(read("dim_time"), "date_key")
    assert sorted(days) == [20220102, 20220103, 20220313, 20220630, 20220701] and days[20220102]["week"] == 52
    location = read("dim_location")
    assert location.columns == ["location_key", "BOROUGH_NORM", "ZIPCODE", "POLICEPRECINCT"]
    assert [tuple(r)[1:] for r in location.orderBy("location_key").collect()] == [
        ("BRONX", 10002, None), ("BRONX", 10003, 9), ("QUEENS", None, 7), ("STATEN ISLAND", 10001, 5), (None, 10001, 5), (None, 10001, None)]
    site = read("dim_firehouse")
    assert site.count() == 4 and "Community Board" in site.columns
    assert [(r["ZIPCODE"], r["BOROUGH_NORM"]) for r in read("bridge_zip_firehouse").orderBy("firehouse_key").collect()] == [
        (10001, "MANHATTAN"), (10002, "BRONX"), (10003, "BRONX")]
    codes = {r["FINAL_CALL_TYPE"]: r["ems_final_call_type_key"] for r in read("dim_ems_final_call_type").collect()}
    assert codes == {"INJURY": 1, "SICK": 2}
    ems = by(read("fact_incident_ems"), "ems_incident_id")
    assert len(ems) == len(EMS)
    assert [ems[i]["dispatch_response_seconds_qy_seconds"] for i in (1, 2, 3, 4)] == [10.0, None, None, 998.9]
    assert [ems[i]["held_indicator"] for i in (1, 2, 3, 4, 5)] == ["1", "0", "X", "0", "1"]
    assert ems[5]["ems_final_call_type_key"] == 2 and ems[5]["ems_disposition_key"] is None
    assert all(r["location_key"] is not None for r in ems.values())
    fire = by(read("fact_incident_fire"), "fire_incident_id")
    assert fire["F1"]["other_units_assigned_quantity"] is None and fire["F1"]["highest_alarm_level"] == "First"
    assert fire["F4"]["fire_class_key"] is None and fire["F4"]["fire_class_group_key"] == 1


def test_marts_on_the_galaxy(galaxy):
    both = facts.combined(
        {"EMS": galaxy["Fact_Incidents_EMS"], "FIRE": galaxy["Fact_Incidents_Fire"]},
        ["date_key", "hour", "nb_interventions", "incident_type_key", "weather_key", "location_key", "travel_time", "dispatch_time", "response_time"],
    )
    speed = by(temporal.volume_vs_speed(both), "hour")
    assert speed[15]["nb_interventions"] == 3 and speed[15]["travel_time"] == (90 + 999 + 200) / 3
    assert speed[12]["nb_interventions"] == 1 and sum(r["nb_interventions"] for r in speed.values()) == 8
    heat = {(r["hour"], r["category"]): r["n"] for r in temporal.risk_heatmap(both, galaxy["Dim_IncidentType"]).collect()}
    assert heat[(15, "Medical")] == 2 and heat[(16, "False")] == 1 and heat[(2, "False")] == 0
    temps = {r["bin_hi"]: r["nb_interventions"] for r in temporal.temp_volume(both, galaxy["Dim_Weather"]).collect()}
    assert temps[35] == 3 and temps[95] == 2 and sum(temps.values()) == 5
    rollup = by(geographic.area_rollup(both, galaxy["Dim_Location"]), "zipcode")
    # two locations of 10001: means 75 and (70 + 240) / 2, each counted once
    assert rollup[10001]["nb_interventions"] == 5 and rollup[10001]["response_time"] == (75 + 155) / 2
    use = by(operational.resource_use(galaxy["Fact_Incidents_Fire"], galaxy["Dim_IncidentType"]), "category")
    assert use["Nonstructural"]["resource_cost_seconds"] == 3 * 240 + 2 * 360 and use["False"]["resource_cost_seconds"] == 0
    links = operational.flow_links(galaxy["Fact_Incidents_EMS"]).collect()
    assert [tuple(r) for r in links] == [("SICK", "INJURY", 2), ("INJURY", "sick ", 1)]
    labels = [r["label"] for r in operational.flow_nodes(operational.flow_links(galaxy["Fact_Incidents_EMS"])).orderBy("node").collect()]
    assert labels == ["SICK (Dispatched As)", "INJURY (Dispatched As)", "INJURY (Actually Was)", "sick  (Actually Was)"]
    bare = operational.flow_nodes(operational.flow_links(galaxy["Fact_Incidents_EMS"]), labelled=False)
    assert bare.count() == 3


def test_feature_matrices(galaxy):
    matrix, fit = multivariate.fire_components(galaxy["Fact_Incidents_Fire"])
    assert matrix.count() == 4 and abs(sum(fit.ratios) - 1) < 1e-12
    zips = galaxy["Dim_Location"].select("location_key", "zipcode")
    ems, fire = (galaxy[f].join(zips, "location_key").select("zipcode", "response_time") for f in ("Fact_Incidents_EMS", "Fact_Incidents_Fire"))
    areas = by(multivariate.area_matrix(ems, fire), "ZIPCODE")
    assert areas[10001]["EMS_Incident_Count"] == 4 and areas[10001]["Fire_Incident_Count"] == 1
    assert areas[10003]["EMS_Incident_Count"] == 0 and areas[10003]["EMS_Avg_Response_Time"] is None


def test_single_code_list_and_absent_columns(spark, raw):
    ems = stage_ems(read_text_table(spark, str(raw / "EMS.csv")))
    dim = dims.code_dim(ems, "FINAL_CALL_TYPE", "key")
    assert [(r["key"], r["FINAL_CALL_TYPE"]) for r in dim.orderBy("key").collect()] == [(1, "INJURY"), (2, "SICK")]
    assert facts.attach_code(ems, dim, "NO_SUCH", "key").filter("key is not null").count() == 0
    assert facts.attach_code(ems, None, "FINAL_CALL_TYPE", "key").filter("key is not null").count() == 0
    mapping = {r["ZIPCODE"]: r["BOROUGH"] for r in dims.area_mapping(ems).collect()}
    assert mapping == {10001: "STATEN ISLAND"}
    fire = stage_fire(read_text_table(spark, str(raw / "FIRE.csv")).drop("INCIDENT_BOROUGH"))
    assert fire.filter("BOROUGH_NORM is not null").count() == 0
