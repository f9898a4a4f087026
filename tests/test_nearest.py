import random

import numpy as np
import pytest

from martloom.operators import nearest
from martloom.plans.geographic import station_reach


def check(spark, points, sites):
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "pid long, x double, y double")
    s = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(sites)], "sid long, sx double, sy double")
    got = {r["point_id"]: (r["site_id"], r["distance2"]) for r in nearest.nearest_site(p, s, "pid", "x", "y", "sid", "sx", "sy").collect()}
    at = np.array(sites, dtype=float)
    assert len(got) == len(points)
    for i, (x, y) in enumerate(points):
        d = (x - at[:, 0]) * (x - at[:, 0]) + (y - at[:, 1]) * (y - at[:, 1])
        assert got[i] == (int(np.argmin(d)), float(d.min())), (i, x, y)


def test_random_positions(spark):
    r = random.Random(5)
    sites = [(r.uniform(-74, -73), r.uniform(40, 41)) for _ in range(700)]
    points = [(r.uniform(-75, -72), r.uniform(39, 42)) for _ in range(300)]
    check(spark, points, sites)


def test_a_third_of_sites_and_points_in_one_spot(spark):
    r = random.Random(6)
    sites = [(r.gauss(0, 1e-6), r.gauss(0, 1e-6)) for _ in range(400)] + [(r.uniform(-50, 50), r.uniform(-50, 50)) for _ in range(300)]
    points = [(r.gauss(0, 1e-6), r.gauss(0, 1e-6)) for _ in range(150)] + [(r.uniform(-60, 60), r.uniform(-60, 60)) for _ in range(150)]
    check(spark, points, sites)


def test_ties_shared_positions_and_single_site(spark):
    check(spark, [(0.0, 0.0), (1.0, 1.0), (0.5, 0.5)], [(1.0, 0.0), (0.0, 1.0), (0.0, 1.0), (-1.0, 0.0)])
    check(spark, [(3.0, 4.0)], [(0.0, 0.0), (0.0, 0.0)])
    check(spark, [(x / 4, 0.0) for x in range(9)], [(float(x), 0.0) for x in range(200)])


def test_shuffled_cells_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(nearest, "_ROOT_CELLS", 1)
    monkeypatch.setattr(nearest, "_LEAF_SITES", 1)
    r = random.Random(7)
    sites = [(r.uniform(0, 9), r.uniform(0, 9)) for _ in range(60)]
    check(spark, [(r.uniform(-1, 10), r.uniform(-1, 10)) for _ in range(50)], sites)


def test_a_hot_cell_is_shuffled_in_parts(spark, monkeypatch):
    """Most points stand in one cell, and cells are too many to broadcast."""
    monkeypatch.setattr(nearest, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(nearest, "_LEAF_SITES", 4)
    r = random.Random(9)
    sites = [(r.uniform(0, 9), r.uniform(0, 9)) for _ in range(80)] + [(5 + r.gauss(0, 1e-3), 5 + r.gauss(0, 1e-3)) for _ in range(40)]
    check(spark, [(5 + r.gauss(0, 1e-3), 5.0) for _ in range(200)] + [(r.uniform(-1, 10), 3.0) for _ in range(30)], sites)


def test_territories_keep_sites_without_areas(spark):
    points = spark.createDataFrame([("1", 0.0, 0.0), ("2", 0.2, 0.0), ("3", 9.0, 0.0)], "area_code string, x double, y double")
    response = spark.createDataFrame([("1", 10.0), ("2", 30.0), ("4", 99.0)], "area_code string, response_time double")
    sites = spark.createDataFrame(
        [(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 0.0, 50.0), (4, None, 1.0)], "firehouse_key int, Latitude double, Longitude double"
    )
    got = {r["site_id"]: (r["response_time"], r["areas"]) for r in station_reach(points, response, sites).collect()}
    assert got == {1: (20.0, 2), 2: (20.0, 2), 3: (None, 0)}


def test_no_sites(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0)], "pid long, x double, y double")
    s = spark.createDataFrame([], "sid long, sx double, sy double")
    assert nearest.nearest_site(p, s, "pid", "x", "y", "sid", "sx", "sy").count() == 0


def test_points_are_moved_once(spark):
    """All levels work on the points where one repartition by id put them."""
    r = random.Random(8)
    s = spark.createDataFrame([(i, r.random(), r.random()) for i in range(5000)], "sid long, sx double, sy double")
    p = spark.createDataFrame([(i, r.random(), r.random()) for i in range(100)], "pid long, x double, y double")
    plan = nearest.nearest_site(p, s, "pid", "x", "y", "sid", "sx", "sy")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(point_id") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Window" not in plan


def test_few_rows_meet_a_point(spark, monkeypatch):
    """Cells and sites that cannot win are dropped where they are measured, before they are rows."""
    met, meet = [], nearest._meet
    monkeypatch.setattr(nearest, "_meet", lambda *a: met.append(out := meet(*a)) or out)
    r = random.Random(10)
    sites = [(r.uniform(0, 100), 4.0 * r.randrange(25)) for _ in range(4000)]
    check(spark, [(r.uniform(0, 100), 4.0 * r.randrange(25)) for _ in range(200)], sites)
    assert met and max(df.count() for df in met) <= 6 * 200


def test_more_sites_than_a_leaf_holds_in_the_smallest_cell(spark, monkeypatch):
    monkeypatch.setattr(nearest, "_DEPTHS", 1)
    monkeypatch.setattr(nearest, "_RESOLUTION", 8)
    monkeypatch.setattr(nearest, "_LEAF_SITES", 4)
    r = random.Random(11)
    sites = [(r.uniform(0, 9), r.uniform(0, 9)) for _ in range(300)] + [(5 + r.gauss(0, 1e-3), 5.0) for _ in range(100)]
    check(spark, [(r.uniform(-1, 10), r.uniform(-1, 10)) for _ in range(100)] + [(5.0, 5.0)], sites)
