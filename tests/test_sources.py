import json

import pytest
from pyspark.sql import functions as F

from martloom.functions.geometry import centroid
from martloom.plans.geographic import area_points
from martloom.plans.dimensions import dim_weather
from martloom.sources import raw, tables
from martloom.streaming.staging import read_raw_stream, stage_new_files


def square(x, y, side, reverse=False):
    ring = [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]
    return ring[::-1] if reverse else ring


FEATURES = [
    {"type": "Feature", "properties": {"MODZCTA": "10001", "n": 1}, "geometry": {"type": "Polygon", "coordinates": [square(0, 0, 4)]}},
    {"type": "Feature", "properties": {"MODZCTA": "10002"},
     "geometry": {"type": "Polygon", "coordinates": [square(0, 0, 4, True), square(0, 0, 2)]}},
    {"type": "Feature", "properties": {"MODZCTA": "10003"},
     "geometry": {"type": "MultiPolygon", "coordinates": [[square(0, 0, 2)], [square(10, 0, 2, True)]]}},
]
CENTROIDS = {"10001": (2.0, 2.0), "10002": (28 / 12, 28 / 12), "10003": (6.0, 1.0)}


@pytest.mark.parametrize("one_per_line", [False, True])
def test_areas_and_centroids(spark, tmp_path, one_per_line):
    path = tmp_path / "areas.json"
    text = "\n".join(map(json.dumps, FEATURES)) if one_per_line else json.dumps({"type": "FeatureCollection", "features": FEATURES})
    path.write_text(text)
    areas = raw.read_areas(spark, str(path), one_per_line=one_per_line)
    got = {r["area_code"]: (r["x"], r["y"]) for r in area_points(areas).collect()}
    assert got.keys() == CENTROIDS.keys()
    for code, at in CENTROIDS.items():
        assert got[code] == pytest.approx(at)


def test_flat_area_has_no_centroid(spark):
    df = spark.createDataFrame([([[[[0.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]],)], "parts array<array<array<array<double>>>>")
    assert tuple(df.select(centroid(F.col("parts")).alias("c")).select("c.*").first()) == (None, None)


def test_weather_json_equals_weather_csv(spark, tmp_path):
    hourly = {"time": ["2022-01-01T00:00", "2022-01-01T01:00"], "temperature_2m": [30.5, None], "precipitation": [0.0, 0.1],
              "weathercode": [3, 61], "windspeed_10m": [5.0, 6.5]}
    (tmp_path / "wx.json").write_text(json.dumps({"latitude": 1, "hourly": hourly}, indent=1))
    rows = raw.read_weather_json(spark, str(tmp_path / "wx.json"))
    assert [tuple(r) for r in rows.orderBy("time").collect()] == [("2022-01-01T00:00", 30.5, 0.0, 3, 5.0), ("2022-01-01T01:00", None, 0.1, 61, 6.5)]
    tables.write_csv(rows, str(tmp_path / "wx.csv"))
    again = raw.read_weather(spark, str(tmp_path / "wx.csv"))
    assert sorted(map(tuple, dim_weather(again).collect())) == sorted(map(tuple, dim_weather(rows).collect()))


def test_csv_reading(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,name,note\n1,"a ""b"", c",NA\n2,,x\n')
    df = raw.read_text_table(spark, str(tmp_path / "t.csv"))
    assert [tuple(r) for r in df.collect()] == [("1", 'a "b", c', None), ("2", None, "x")]
    assert raw.read_text_table(spark, str(tmp_path / "t.csv"), ["note"]).columns == ["note"]
    with pytest.raises(ValueError, match="zip"):
        raw.read_text_table(spark, str(tmp_path / "t.csv"), ["zip"])
    keyed = raw.read_keyed_csv(spark, str(tmp_path / "t.csv"), {"id": "bigint"})
    assert keyed.schema["id"].dataType.simpleString() == "bigint"


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2022), (2, "b", 2023)], "k int, v string, year int")
    tables.write_tables({"t": df}, str(tmp_path))
    tables.write_table(df, str(tmp_path), "p", ["year"])
    assert sorted(map(tuple, tables.read_table(spark, str(tmp_path), "t").collect())) == [(1, "a", 2022), (2, "b", 2023)]
    assert tables.read_table(spark, str(tmp_path), "p", ["v"]).columns == ["v"]
    tables.write_table(df.limit(1), str(tmp_path), "t")
    assert tables.read_table(spark, str(tmp_path), "t").count() == 1


def test_new_files_are_staged_once(spark, tmp_path):
    columns = ["CAD_INCIDENT_ID", "INCIDENT_DATETIME", "ZIPCODE", "BOROUGH"]
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def arrive(name, zip_text):
        (source / name).write_text(",".join(columns) + f"\n1,01/02/2022 03:04:05 PM,{zip_text},richmond\n")
        query = stage_new_files(read_raw_stream(spark, str(source), columns), "BOROUGH", out, str(tmp_path / "cp"))
        query.awaitTermination(120)
        return sorted((r["ZIPCODE"] or 0, r["BOROUGH_NORM"], r["HOUR"]) for r in spark.read.parquet(out).collect())

    assert arrive("a.csv", "10001.0") == [(10001, "STATEN ISLAND", 15)]
    assert arrive("b.csv", "x") == [(0, "STATEN ISLAND", 15), (10001, "STATEN ISLAND", 15)]
