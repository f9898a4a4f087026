import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.operators.fits import linear_fit, quadratic_fit
from martloom.plans import geographic as geo
from martloom.plans import operational as ops
from martloom.plans import temporal


def test_fixed_bins_leave_out_the_edges(spark):
    fact = spark.createDataFrame([(i, 1) for i in range(7)], "weather_key int, nb_interventions int")
    weather = spark.createDataFrame(list(enumerate([0.0, 5.0, 5.1, 105.0, 106.0, None, -3.0])), "weather_key int, temp_f double")
    rows = {r["bin_hi"]: r for r in temporal.temp_volume(fact, weather).collect()}
    assert sorted(rows) == list(range(5, 110, 5))
    assert {k: r["nb_interventions"] for k, r in rows.items() if r["nb_interventions"]} == {5: 1, 10: 1, 105: 1}
    assert (rows[5]["bin_lo"], rows[5]["bin_mid"]) == (0, 2.5)
    loose = {r["temp_bin"]: r["nb_interventions"] for r in temporal.temp_volume_floor(fact, weather).collect()}
    assert loose == {0: 1, 5: 2, 105: 2, -5: 1}
    trend = temporal.temp_trend(fact, weather).first()
    mids, n = np.arange(2.5, 105, 5), np.zeros(21)
    n[[0, 1, 20]] = 1
    slope, intercept = np.polyfit(mids, n, 1)
    assert trend["slope"] == pytest.approx(slope) and trend["intercept"] == pytest.approx(intercept) and trend["n"] == 21


def test_groups_without_key_or_value(spark):
    fact = spark.createDataFrame([(1, None, None), (None, 5, 1.0), (2, 3, None)], "hour int, nb_interventions int, travel_time double")
    rows = {r["hour"]: (r["nb_interventions"], r["travel_time"]) for r in temporal.volume_vs_speed(fact).collect()}
    assert rows == {1: (0, None), 2: (3, None)}


def test_top_categories_go_by_rows_not_volume(spark):
    types = spark.createDataFrame([(i, f"c{i:02d}") for i in range(12)], "incident_type_key int, category string")
    rows = [(i, 3, 1) for i in range(12) for _ in range(20 - i)] + [(11, 4, 1000)]
    fact = spark.createDataFrame(rows, "incident_type_key int, hour int, nb_interventions int")
    # the last category has the largest volume but too few rows
    got = temporal.risk_heatmap(fact, types)
    assert sorted(tuple(r) for r in got.collect()) == [(3, f"c{i:02d}", 20 - i) for i in range(10)]
    everything = temporal.risk_heatmap(fact, types, top=None)
    assert everything.count() == 24 and everything.agg(F.sum("n")).first()[0] == 1000 + sum(20 - i for i in range(12))


def test_quadratic_fit_matches_least_squares(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(1, 60, 400)
    y = 50 + 0.7 * x + 0.02 * x**2 + rng.normal(0, 5, 400)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(x, y)] + [(1, None), (None, 1.0)], "x int, y double")
    got = quadratic_fit(df, "x", "y").first()
    c2, c1, c0 = np.polyfit(x, y, 2)
    assert (got["c0"], got["c1"], got["c2"], got["n"]) == pytest.approx((c0, c1, c2, 400))
    line = linear_fit(df, "x", "y").first()
    assert line["slope"] == pytest.approx(np.polyfit(x, y, 1)[0])
    flat = quadratic_fit(df.filter("x < 3"), "x", "y").first()
    assert flat["c2"] is None


def test_stress_bins(spark):
    rows = [(1, 1, 15, 100.0), (1, 1, 5, 300.0), (1, 2, 21, 50.0), (1, 3, 40, 70.0), (1, 4, 0, 1.0), (1, 5, 9, 900.0), (None, 1, 9, 1.0)]
    fact = spark.createDataFrame(rows, "date_key int, hour int, total_units int, dispatch_time double")
    got = {(r["bin_lo"], r["bin_hi"], r["bin_mid"]): r["dispatch_time"] for r in ops.stress_test(fact).collect()}
    assert got == {(0, 20, 10.0): 200.0, (20, 40, 30.0): 60.0}


def test_flow_variants(spark):
    rows = [("a", "b")] * 3 + [("b", "a")] * 2 + [("a", "a")] * 5 + [("a", None), (None, "a")]
    fact = spark.createDataFrame(rows, "initial_call_type string, final_call_type string")
    links = ops.flow_links(fact)
    assert [tuple(r) for r in links.collect()] == [("a", "b", 3), ("b", "a", 2)]
    assert [tuple(r) for r in ops.flow_links_all(fact).collect()][0] == ("a", "a", 5)
    assert sorted(map(tuple, ops.flow_indices(links).collect())) == [(0, 2, 3), (1, 3, 2)]
    assert sorted(map(tuple, ops.flow_indices(links, labelled=False).collect())) == [(0, 1, 3), (1, 0, 2)]


def test_delay_shares(spark):
    fact = spark.createDataFrame([(1, 30.0, 60.0), (1, 30.0, 120.0), (2, 0.0, 0.0)], "hour int, dispatch_time double, travel_time double")
    got = {r["hour"]: (r["dispatch_pct"], r["travel_pct"]) for r in ops.delay_anatomy(fact).collect()}
    assert got[1] == pytest.approx((25.0, 75.0)) and got[2] == (None, None)


def test_triage_and_speed_trap(spark):
    rollup = spark.createDataFrame(
        [(1, 100, 10.0), (2, 10, 90.0), (3, 90, 80.0), (4, 12, 20.0), (5, 95, None)], "zipcode long, nb_interventions long, response_time double"
    )
    rows = {r["zipcode"]: r for r in geo.triage_matrix(rollup).collect()}
    assert [rows[z]["quadrant"] for z in range(1, 6)] == ["efficient hub", "hard to reach", "problem area", "quiet enclave", None]
    assert [rows[z]["is_critical"] for z in range(1, 6)] == [0, 0, 1, 0, 0]
    assert [r["zipcode"] for r in geo.triage_top(rollup).collect()] == [3]
    assert geo.triage_top_dist(rollup).first()["dist"] == pytest.approx((90 - 61.4) * (80 - 50))
    areas = spark.createDataFrame([("1",), ("3",), ("9",)], "area_code string")
    trap = {r["area_code"]: (r["nb_interventions"], r["ring_size"]) for r in geo.speed_trap(rollup, areas).collect()}
    assert trap == {"1": (100, 800.0), "3": (90, 720.0), "9": (None, None)}


def test_exact_means_do_not_depend_on_the_order_of_rows(spark):
    rng = np.random.default_rng(5)
    rows = [
        (int(h), int(d), int(u), float(a), float(b), int(k))
        for h, d, u, a, b, k in zip(
            rng.integers(0, 24, 2000), rng.integers(1, 4, 2000), rng.integers(1, 9, 2000),
            rng.random(2000) * 99, rng.random(2000) * 99, rng.integers(0, 40, 2000),
        )
    ]
    columns = "hour int, date_key int, total_units int, dispatch_time double, travel_time double, location_key int"
    location = spark.createDataFrame([(k, 100 + k % 5) for k in range(40)], "location_key int, zipcode int")

    def marts(order, parts, exact):
        fact = spark.createDataFrame([rows[i] for i in order], columns).repartition(parts)
        fact = fact.withColumn("nb_interventions", F.lit(1)).withColumn("response_time", F.col("dispatch_time"))
        results = [
            temporal.volume_vs_speed(fact, exact), temporal.shift_change(fact, exact), ops.stress_test(fact, exact=exact),
            ops.delay_anatomy(fact, exact), geo.area_rollup(fact, location, exact),
        ]
        return [sorted(tuple(r) for r in df.collect()) for df in results]

    first = marts(range(2000), 2, True)
    assert first == marts(rng.permutation(2000), 7, True)
    for got, plain in zip(first, marts(range(2000), 3, False)):
        assert np.allclose(np.array(got, float), np.array(plain, float))
