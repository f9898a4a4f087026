"""Temporal, geographic, operational and multivariate marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.operators.components import Components, correlation_table, fit_components
from martloom.operators.exact import exact_group
from martloom.operators.nearest import nearest_site
from martloom.plans import geographic as geo
from martloom.plans import multivariate as multi
from martloom.plans import operational as ops
from martloom.plans import temporal
from martloom.plans.facts import combined
from martloom.storage import store
from workload import roles
from workload.registry import query, table
from workload.roles import A, HOURLY, date_key

# --- facts of the marts, with natural keys in place of surrogate ones ---


def incidents_a(spark, sf):
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    dispatch = F.floor(F.col("value") * 4).cast("double")
    return table(spark, sf, "events").select(
        roles.times_key("ts").alias("date_key"),
        F.hour("ts").alias("hour"),
        (roles.times_key("ts").cast("bigint") * 100 + F.hour("ts")).alias("weather_key"),
        F.col("event_type").alias("incident_type_key"),
        F.lit(1).alias("nb_interventions"),
        dispatch.alias("dispatch_time"),
        F.when(k % 20 != 5, (k * 10).cast("double")).alias("travel_time"),
    )


def incidents_b(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("at", roles.later("l_shipdate", hours=F.col("l_partkey") % 24))
    return lines.select(
        roles.times_key("at").alias("date_key"),
        F.hour("at").alias("hour"),
        F.col("l_partkey").alias("incident_type_key"),
        F.lit(1).alias("nb_interventions"),
        F.floor(F.col("l_extendedprice") / 100).cast("double").alias("dispatch_time"),
        F.floor(F.col("l_extendedprice") / 250).cast("double").alias("travel_time"),
        F.col("l_quantity").cast("int").alias("total_units"),
    )


INCIDENTS = f"""
ia AS (
  SELECT {date_key('ts')} AS date_key, hour(ts) AS hour, floor(value * 4) AS dispatch_time,
         CASE WHEN k % 20 <> 5 THEN k * 10 END AS travel_time
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)),
ib AS (
  SELECT {date_key('shifted')} AS date_key, hour(shifted) AS hour, l_partkey, floor(l_extendedprice / 100) AS dispatch_time,
         floor(l_extendedprice / 250) AS travel_time, CAST(l_quantity AS INTEGER) AS total_units
  FROM (SELECT *, l_shipdate + to_hours(l_partkey % 24) AS shifted FROM lineitem))
"""


def part_types(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("incident_type_key"), F.col("p_brand").alias("category"))


def hourly_weather(spark, sf):
    return roles.hourly_events(spark, sf).select(
        (roles.times_key("h").cast("bigint") * 100 + F.hour("h")).alias("weather_key"), F.col("temp").alias("temp_f")
    )


# --- temporal ---


@query(
    "volume_vs_speed",
    "hour:int nb_interventions:int travel_time:float",
    """SELECT hour, count(*) AS nb_interventions, avg(travel_time) AS travel_time
       FROM (SELECT hour, travel_time FROM ia UNION ALL SELECT hour, travel_time FROM ib) GROUP BY hour""",
    INCIDENTS,
)
def volume_vs_speed(spark, sf):
    columns = ["hour", "nb_interventions", "travel_time"]
    both = {"A": incidents_a(spark, sf), "B": incidents_b(spark, sf)}
    return temporal.volume_vs_speed(combined(both, columns))


HEATMAP = """
counts AS (SELECT p_brand AS category, hour, count(*) AS n FROM ib JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
seen AS (SELECT DISTINCT hour FROM counts)
"""


@query(
    "risk_heatmap",
    "hour:int category:text n:int",
    """SELECT s.hour, best.category, coalesce(c.n, 0) AS n
       FROM (SELECT category FROM counts GROUP BY 1 ORDER BY sum(n) DESC, category LIMIT 10) best CROSS JOIN seen s
       LEFT JOIN counts c ON c.category = best.category AND c.hour = s.hour""",
    f"{INCIDENTS}, {HEATMAP}",
)
def risk_heatmap(spark, sf):
    return temporal.risk_heatmap(incidents_b(spark, sf), part_types(spark, sf))


@query(
    "risk_heatmap_all",
    "hour:int category:text n:int",
    """SELECT s.hour, x.category, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT category FROM counts) x CROSS JOIN seen s
       LEFT JOIN counts c ON c.category = x.category AND c.hour = s.hour""",
    f"{INCIDENTS}, {HEATMAP}",
)
def risk_heatmap_all(spark, sf):
    return temporal.risk_heatmap(incidents_b(spark, sf), part_types(spark, sf), top=None)


@query(
    "shift_change",
    "hour:int dispatch_time:float is_shift_change:int",
    """SELECT hour, avg(dispatch_time) AS dispatch_time, CASE WHEN hour IN (9, 18) THEN 1 ELSE 0 END AS is_shift_change
       FROM (SELECT hour, dispatch_time FROM ia UNION ALL SELECT hour, dispatch_time FROM ib) GROUP BY hour""",
    INCIDENTS,
)
def shift_change(spark, sf):
    columns = ["hour", "dispatch_time"]
    return temporal.shift_change(combined({"A": incidents_a(spark, sf), "B": incidents_b(spark, sf)}, columns))


WEATHER = """
by_temp AS (
  SELECT w.temp AS temp_f, count(*) AS n FROM events e JOIN hours w ON date_trunc('hour', e.ts) = w.h GROUP BY w.h, w.temp),
bins AS (
  SELECT b.top - 5 AS bin_lo, b.top AS bin_hi, b.top - 2.5 AS bin_mid, coalesce(sum(t.n), 0) AS nb_interventions
  FROM (SELECT unnest(generate_series(5, 105, 5)) AS top) b
  LEFT JOIN by_temp t ON t.temp_f > b.top - 5 AND t.temp_f <= b.top GROUP BY b.top),
floor_bins AS (SELECT floor(temp_f / 5) * 5 AS temp_bin, sum(n) AS nb_interventions FROM by_temp GROUP BY 1)
"""
FIT = "round(regr_slope({y}, {x}), 6) AS slope, round(regr_intercept({y}, {x}), 6) AS intercept, round(regr_r2({y}, {x}), 6) AS r2, count(*) AS n"


@query(
    "temp_volume",
    "bin_lo:int bin_hi:int bin_mid:float nb_interventions:int",
    "SELECT * FROM bins",
    f"{HOURLY}, {WEATHER}",
)
def temp_volume(spark, sf):
    return temporal.temp_volume(incidents_a(spark, sf), hourly_weather(spark, sf))


@query(
    "temp_trend",
    "slope:float6 intercept:float6 r2:float6 n:int",
    f"SELECT {FIT.format(x='bin_mid', y='nb_interventions')} FROM bins",
    f"{HOURLY}, {WEATHER}",
)
def temp_trend(spark, sf):
    return temporal.temp_trend(incidents_a(spark, sf), hourly_weather(spark, sf))


@query(
    "temp_volume_floor",
    "temp_bin:int nb_interventions:int",
    "SELECT * FROM floor_bins",
    f"{HOURLY}, {WEATHER}",
)
def temp_volume_floor(spark, sf):
    return temporal.temp_volume_floor(incidents_a(spark, sf), hourly_weather(spark, sf))


@query(
    "temp_trend_floor",
    "slope:float6 intercept:float6 r2:float6 n:int",
    f"SELECT {FIT.format(x='temp_bin', y='nb_interventions')} FROM floor_bins",
    f"{HOURLY}, {WEATHER}",
)
def temp_trend_floor(spark, sf):
    return temporal.temp_trend_floor(incidents_a(spark, sf), hourly_weather(spark, sf))


# --- geographic ---


def rollup(spark, sf, exact=False):
    """Orders are the incidents, customers the locations, nations the zips."""
    fact = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("location_key"),
        F.lit(1).alias("nb_interventions"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("response_time"),
    )
    location = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("location_key"), (F.col("c_nationkey") + 10000).alias("zipcode")
    )
    return geo.area_rollup(fact, location, exact)


ROLLUP = """
per_location AS (SELECT o_custkey, count(*) AS volume, avg(floor(o_totalprice / 1000)) AS response FROM orders GROUP BY 1),
rollup_areas AS (
  SELECT 10000 + c_nationkey AS zipcode, sum(volume) AS nb_interventions, avg(response) AS response_time
  FROM per_location JOIN customer ON o_custkey = c_custkey GROUP BY 1),
means AS (SELECT avg(nb_interventions) AS avg_volume, avg(response_time) AS avg_response FROM rollup_areas)
"""


@query(
    "area_rollup",
    "zipcode:int nb_interventions:int response_time:float6",
    "SELECT * FROM rollup_areas",
    ROLLUP,
)
def area_rollup(spark, sf):
    return rollup(spark, sf)


@query(
    "exact_area_rollup",
    "zipcode:int nb_interventions:int response_time:float6",
    "SELECT * FROM rollup_areas",
    ROLLUP,
)
def exact_area_rollup(spark, sf):
    """The two-level mean with sums that do not depend on the order of rows."""
    return rollup(spark, sf, exact=True)


@query(
    "speed_trap",
    "area_code:text nb_interventions:int response_time:float6 ring_size:float6",
    """SELECT area_code, nb_interventions, response_time, nb_interventions / (SELECT max(nb_interventions) FROM rollup_areas) * 800 AS ring_size
       FROM (SELECT CAST(10000 + n_nationkey AS VARCHAR) AS area_code FROM nation
             UNION ALL SELECT 'R' || r_regionkey FROM region) LEFT JOIN rollup_areas ON area_code = CAST(zipcode AS VARCHAR)""",
    ROLLUP,
)
def speed_trap(spark, sf):
    nations = table(spark, sf, "nation").select((F.col("n_nationkey") + 10000).cast("string").alias("area_code"))
    regions = table(spark, sf, "region").select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("area_code"))
    return geo.speed_trap(rollup(spark, sf), nations.unionByName(regions))


@query(
    "triage_matrix",
    "zipcode:int nb_interventions:int response_time:float6 avg_volume:float6 avg_response:float6 quadrant:text is_critical:int",
    """SELECT *, CASE WHEN nb_interventions > avg_volume AND response_time > avg_response THEN 'problem area'
         WHEN nb_interventions > avg_volume THEN 'efficient hub' WHEN response_time > avg_response THEN 'hard to reach'
         ELSE 'quiet enclave' END AS quadrant,
         CASE WHEN nb_interventions > avg_volume AND response_time > avg_response THEN 1 ELSE 0 END AS is_critical
       FROM rollup_areas CROSS JOIN means""",
    ROLLUP,
)
def triage_matrix(spark, sf):
    return geo.triage_matrix(rollup(spark, sf))


@query(
    "triage_top",
    "zipcode:int nb_interventions:int response_time:float6 impact:float6",
    """SELECT *, nb_interventions * response_time AS impact FROM rollup_areas CROSS JOIN means
       WHERE nb_interventions > avg_volume AND response_time > avg_response ORDER BY impact DESC, zipcode LIMIT 5""",
    ROLLUP,
)
def triage_top(spark, sf):
    return geo.triage_top(rollup(spark, sf))


@query(
    "triage_top_dist",
    "zipcode:int nb_interventions:int response_time:float6 dist:float6",
    """SELECT *, (nb_interventions - avg_volume) * (response_time - avg_response) AS dist FROM rollup_areas CROSS JOIN means
       WHERE nb_interventions > avg_volume AND response_time > avg_response ORDER BY dist DESC, zipcode LIMIT 5""",
    ROLLUP,
)
def triage_top_dist(spark, sf):
    return geo.triage_top_dist(rollup(spark, sf))


@query(
    "polygon_centroid",
    "area_code:text x:float6 y:float6",
    """SELECT CAST(c_nationkey AS VARCHAR) AS area_code,
         (w * h * (x0 + w / 2) - w / 4 * (h / 2) * (x0 + w / 4 + w / 8) + w * 2 * (x0 + 3 * w + 1)) / (w * h - w / 4 * (h / 2) + w * 2) AS x,
         (w * h * (y0 + h / 2) - w / 4 * (h / 2) * (y0 + h / 4 + h / 4) + w * 2 * (y0 + w / 2)) / (w * h - w / 4 * (h / 2) + w * 2) AS y
       FROM (SELECT c_nationkey, min(floor(c_acctbal)) AS x0, min(c_custkey) AS y0, max(floor(c_acctbal)) - min(floor(c_acctbal)) + 1 AS w,
                    max(c_custkey) - min(c_custkey) + 1 AS h FROM customer GROUP BY 1)""",
)
def polygon_centroid(spark, sf):
    """Per nation the bounding box of its customers with a hole, and a second box beside it."""

    def ring(x, y, w, h, clockwise=False):
        corners = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
        if clockwise:
            corners.reverse()
        return F.array(*[F.array(a.cast("double"), b.cast("double")) for a, b in corners])

    box = table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.min(F.floor("c_acctbal")).alias("x0"), F.min("c_custkey").alias("y0"),
        (F.max(F.floor("c_acctbal")) - F.min(F.floor("c_acctbal")) + 1).alias("w"),
        (F.max("c_custkey") - F.min("c_custkey") + 1).alias("h"),
    )
    x, y, w, h = (F.col(c).cast("double") for c in ("x0", "y0", "w", "h"))
    holed = F.array(ring(x, y, w, h), ring(x + w / 4, y + h / 4, w / 4, h / 2))
    beside = F.array(ring(x + 3 * w, y, F.lit(2.0), w, clockwise=True))
    areas = box.select(F.col("c_nationkey").cast("string").alias("area_code"), F.array(holed, beside).alias("parts"))
    return geo.area_points(areas)


def customer_points(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("area_code"), F.col("c_acctbal").alias("x"), (F.col("c_nationkey") * 400).cast("double").alias("y")
    )


def supplier_sites(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("firehouse_key"),
        F.col("s_acctbal").alias("Longitude"),
        (F.col("s_nationkey") * 400).cast("double").alias("Latitude"),
    )


NEAREST = """
assigned AS (
  SELECT c_custkey, arg_min(s_suppkey, struct_pack(d := d, s := s_suppkey)) AS site_id, min(d) AS distance2 FROM (
    SELECT c_custkey, s_suppkey, (c_acctbal - s_acctbal) * (c_acctbal - s_acctbal)
           + (c_nationkey * 400.0::DOUBLE - s_nationkey * 400.0::DOUBLE) * (c_nationkey * 400.0::DOUBLE - s_nationkey * 400.0::DOUBLE) AS d
    FROM customer CROSS JOIN supplier) GROUP BY 1)
"""


@query(
    "nearest_site",
    "point_id:int site_id:int distance2:float",
    "SELECT c_custkey AS point_id, site_id, distance2 FROM assigned",
    NEAREST,
)
def nearest_site_query(spark, sf):
    return nearest_site(
        customer_points(spark, sf), supplier_sites(spark, sf), "area_code", "x", "y", "firehouse_key", "Longitude", "Latitude"
    )


@query(
    "station_reach",
    "site_id:int response_time:float6 areas:int",
    """SELECT s_suppkey AS site_id, avg(response) AS response_time, count(response) AS areas FROM supplier
       LEFT JOIN (SELECT site_id, response FROM assigned JOIN per_location ON c_custkey = o_custkey) ON site_id = s_suppkey GROUP BY 1""",
    f"{NEAREST}, {ROLLUP}",
)
def station_reach(spark, sf):
    response = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("area_code")).agg(
        F.avg(F.floor(F.col("o_totalprice") / 1000).cast("double")).alias("response_time")
    )
    return geo.station_reach(customer_points(spark, sf), response, supplier_sites(spark, sf))


# --- operational ---


def call_types(spark, sf):
    placed = roles.placed_events(spark, sf)
    k, event = F.col("k"), F.col("event_type")
    final = F.when(k % 4 == 0, F.col("seg")).when(k != 7, event)
    return placed.select(event.alias("initial_call_type"), final.alias("final_call_type"))


FLOWS = """
links AS (SELECT initial_call_type, final_call_type, count(*) AS value FROM a
  WHERE initial_call_type <> final_call_type GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20),
ranked AS (SELECT *, row_number() OVER (ORDER BY value DESC, initial_call_type, final_call_type) AS r FROM links),
ends AS (SELECT initial_call_type || ' (Dispatched As)' AS label, 0 AS side, r FROM ranked
  UNION ALL SELECT final_call_type || ' (Actually Was)', 1, r FROM ranked),
first_seen AS (SELECT label, min(side * 100 + r) AS pos FROM ends GROUP BY 1),
nodes AS (SELECT row_number() OVER (ORDER BY pos) - 1 AS node, label FROM first_seen)
"""


@query(
    "flow_links",
    "initial_call_type:text final_call_type:text value:int",
    "SELECT * FROM links",
    f"{A}, {FLOWS}",
)
def flow_links(spark, sf):
    return ops.flow_links(call_types(spark, sf))


@query("flow_nodes", "node:int label:text", "SELECT * FROM nodes", f"{A}, {FLOWS}")
def flow_nodes(spark, sf):
    return ops.flow_nodes(ops.flow_links(call_types(spark, sf)))


@query(
    "flow_indices",
    "source:int target:int value:int",
    """SELECT s.node AS source, t.node AS target, value FROM links JOIN nodes s ON s.label = initial_call_type || ' (Dispatched As)'
       JOIN nodes t ON t.label = final_call_type || ' (Actually Was)'""",
    f"{A}, {FLOWS}",
)
def flow_indices(spark, sf):
    return ops.flow_indices(ops.flow_links(call_types(spark, sf)))


@query(
    "flow_links_all",
    "initial_call_type:text final_call_type:text value:int",
    """SELECT initial_call_type, final_call_type, count(*) AS value FROM a WHERE initial_call_type IS NOT NULL
       AND final_call_type IS NOT NULL GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""",
    A,
)
def flow_links_all(spark, sf):
    return ops.flow_links_all(call_types(spark, sf))


@query(
    "stress_test",
    "bin_lo:int bin_hi:int bin_mid:float dispatch_time:float6",
    """SELECT ceil(units / 20.0) * 20 - 20 AS bin_lo, ceil(units / 20.0) * 20 AS bin_hi, ceil(units / 20.0) * 20 - 10 AS bin_mid,
         avg(dispatch) AS dispatch_time
       FROM (SELECT date_key, hour, sum(total_units) AS units, avg(dispatch_time) AS dispatch FROM ib GROUP BY 1, 2)
       WHERE dispatch < 600 AND units > 0 GROUP BY 1, 2, 3""",
    INCIDENTS,
)
def stress_test(spark, sf):
    return ops.stress_test(incidents_b(spark, sf))


STRESS = """SELECT ceil(units / 20.0) * 20 - 20 AS bin_lo, ceil(units / 20.0) * 20 AS bin_hi, ceil(units / 20.0) * 20 - 10 AS bin_mid,
         avg(dispatch) AS dispatch_time
       FROM (SELECT date_key, hour, sum(total_units) AS units, avg(dispatch_time) AS dispatch FROM ib GROUP BY 1, 2)
       WHERE dispatch < 600 AND units > 0 GROUP BY 1, 2, 3"""


@query("exact_stress_test", "bin_lo:int bin_hi:int bin_mid:float dispatch_time:float6", STRESS, INCIDENTS)
def exact_stress_test(spark, sf):
    """Both levels of means with sums that do not depend on the order of rows."""
    return ops.stress_test(incidents_b(spark, sf), exact=True)


@query(
    "exact_charges",
    "l_returnflag:text l_linestatus:text charge:float mean_charge:float n:int",
    """SELECT l_returnflag, l_linestatus, total AS charge, total / n AS mean_charge, n FROM (
         SELECT *, (CAST(units // 9007199254740992 AS DOUBLE) * CAST(9007199254740992 AS DOUBLE)
                    + CAST(units % 9007199254740992 AS DOUBLE)) / CAST(1152921504606846976 AS DOUBLE) AS total
         FROM (SELECT l_returnflag, l_linestatus, count(*) AS n, sum(CAST(charge * CAST(1152921504606846976 AS DOUBLE) AS HUGEINT)) AS units
               FROM (SELECT *, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem) GROUP BY 1, 2))""",
)
def exact_charges(spark, sf):
    """Sums and means of doubles bit for bit: the SQL adds them as whole numbers of 2^-60."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    lines = table(spark, sf, "lineitem").withColumn("charge", charge)
    by = ["l_returnflag", "l_linestatus"]
    return exact_group(lines, by, means={"mean_charge": "charge"}, sums={"charge": "charge"}, wholes={"n": F.lit(1)})


@query(
    "saturation_fit",
    "c0:float6 c1:float6 c2:float6 n:int",
    """SELECT a - b * m + c * m * m AS c0, b - 2 * c * m AS c1, c AS c2, n FROM (
         SELECT *, (t1 - s3 * c) / s2 AS b, (t0 - s2 * c) / n AS a FROM (
           SELECT *, (t2 - s3 / s2 * t1 - s2 / n * t0) / (s4 - s3 * s3 / s2 - s2 * s2 / n) AS c FROM (
             SELECT count(*) AS n, max(m) AS m, sum(u * u) AS s2, sum(u * u * u) AS s3, sum(u * u * u * u) AS s4,
                    sum(y) AS t0, sum(u * y) AS t1, sum(u * u * y) AS t2
             FROM (SELECT total_units - (SELECT avg(total_units) FROM ib WHERE dispatch_time < 600) AS u, dispatch_time AS y,
                          (SELECT avg(total_units) FROM ib WHERE dispatch_time < 600) AS m FROM ib WHERE dispatch_time < 600))))""",
    INCIDENTS,
)
def saturation_fit(spark, sf):
    return ops.saturation_fit(incidents_b(spark, sf))


@query(
    "resource_consumption",
    "category:text resource_cost_seconds:float resource_hours:float",
    """SELECT p_brand AS category, sum(total_units * (dispatch_time + travel_time)) AS resource_cost_seconds,
         sum(total_units * (dispatch_time + travel_time)) / 3600 AS resource_hours
       FROM ib JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""",
    INCIDENTS,
)
def resource_consumption(spark, sf):
    return ops.resource_consumption(incidents_b(spark, sf), part_types(spark, sf))


@query(
    "delay_anatomy",
    "hour:int dispatch_pct:float6 travel_pct:float6",
    """SELECT hour, avg(dispatch_time) / (avg(dispatch_time) + avg(travel_time)) * 100 AS dispatch_pct,
         avg(travel_time) / (avg(dispatch_time) + avg(travel_time)) * 100 AS travel_pct FROM ia GROUP BY 1""",
    INCIDENTS,
)
def delay_anatomy(spark, sf):
    return ops.delay_anatomy(incidents_a(spark, sf))


# --- multivariate ---


def line_features(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").alias("quantity"),
        F.floor("l_extendedprice").cast("double").alias("price"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
        F.nullif(F.round(F.col("l_tax") * 100).cast("int"), F.lit(8)).alias("tax"),
    )


LINE_FEATURES = ["quantity", "price", "discount", "tax"]
LINES = """
raw_lines AS (
  SELECT l_orderkey, l_linenumber, l_quantity AS quantity, floor(l_extendedprice) AS price, round(l_discount * 100) AS discount,
         nullif(round(l_tax * 100), 8) AS tax FROM lineitem),
lines AS (SELECT * REPLACE (coalesce(tax, (SELECT avg(tax) FROM raw_lines)) AS tax) FROM raw_lines)
"""


@query(
    "standardise",
    "l_orderkey:int l_linenumber:int quantity:float6 price:float6 discount:float6 tax:float6",
    """SELECT l_orderkey, l_linenumber, (quantity - mq) / sq AS quantity, (price - mp) / sp AS price, (discount - md) / sd AS discount, (tax - mt) / st AS tax
       FROM lines CROSS JOIN (SELECT avg(quantity) AS mq, stddev_pop(quantity) AS sq, avg(price) AS mp, stddev_pop(price) AS sp,
         avg(discount) AS md, stddev_pop(discount) AS sd, avg(tax) AS mt, stddev_pop(tax) AS st FROM lines)""",
    LINES,
)
def standardise(spark, sf):
    lines = line_features(spark, sf)
    return fit_components(lines, LINE_FEATURES).standardised(lines, ["l_orderkey", "l_linenumber"])


@query(
    "pca_corr_matrix",
    "feature_a:text feature_b:text corr:float6",
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {'1.0' if a == b else f'corr({a}, {b})'} AS corr FROM lines"
        + (" GROUP BY 1, 2" if a == b else "")
        for i, a in enumerate(LINE_FEATURES)
        for b in LINE_FEATURES[i:]
    ),
    LINES,
)
def pca_corr_matrix(spark, sf):
    return correlation_table(fit_components(line_features(spark, sf), LINE_FEATURES))


@query("pca_eigen_lines", "pc:int eigenvalue:float6 ratio:float6 cumulative:float6")
def pca_eigen_lines(spark, sf):
    """Four features have no closed form in SQL; tests compare this with a direct computation."""
    return fit_components(line_features(spark, sf), LINE_FEATURES).eigen()


def customer_matrix(spark, sf):
    """Per customer with orders: how many and how much, two features with a closed form."""
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.sum(F.floor(F.col("o_totalprice") / 1000)).alias("spent")
    )


def customer_fit(spark, sf) -> tuple:
    matrix = store(customer_matrix(spark, sf), "customer_matrix")
    return matrix, fit_components(matrix, ["orders", "spent"])


TWO = """
m AS (SELECT o_custkey, count(*) AS orders, sum(floor(o_totalprice / 1000)) AS spent FROM orders GROUP BY 1),
f AS (SELECT count(*) AS n, corr(orders, spent) AS r, avg(orders) AS mo, stddev_pop(orders) AS so, avg(spent) AS ms,
             stddev_pop(spent) AS ss FROM m),
z AS (SELECT o_custkey, (orders - mo) / so AS z1, (spent - ms) / ss AS z2, r, n FROM m CROSS JOIN f),
s AS (SELECT o_custkey, z1, z2, (z1 + sign(r) * z2) / sqrt(2) AS pc1, (z1 - sign(r) * z2) / sqrt(2) AS pc2 FROM z),
e AS (SELECT 1 AS pc, (1 + abs(r)) * n / (n - 1) AS eigenvalue, (1 + abs(r)) / 2 AS ratio, (1 + abs(r)) / 2 AS cumulative FROM f
      UNION ALL SELECT 2, (1 - abs(r)) * n / (n - 1), (1 - abs(r)) / 2, 1.0 FROM f)
"""


@query("pca_eigen", "pc:int eigenvalue:float6 ratio:float6 cumulative:float6", "SELECT * FROM e", TWO)
def pca_eigen(spark, sf):
    return customer_fit(spark, sf)[1].eigen()


@query(
    "pca_scree",
    "pc:int percent:float6 cumulative_percent:float6",
    "SELECT pc, ratio * 100 AS percent, cumulative * 100 AS cumulative_percent FROM e",
    TWO,
)
def pca_scree(spark, sf):
    return customer_fit(spark, sf)[1].scree()


@query(
    "pca_loadings",
    "feature:text pc:int loading:float6",
    """SELECT 'orders' AS feature, pc, sqrt(eigenvalue / 2) AS loading FROM e
       UNION ALL SELECT 'spent', pc, CASE WHEN pc = 1 THEN 1 ELSE -1 END * (SELECT sign(r) FROM f) * sqrt(eigenvalue / 2) FROM e""",
    TWO,
)
def pca_loadings(spark, sf):
    return customer_fit(spark, sf)[1].loadings()


@query(
    "pca_circle",
    "feature:text x:float6 y:float6",
    """SELECT 'orders' AS feature, sqrt(a.eigenvalue / 2) AS x, sqrt(b.eigenvalue / 2) AS y FROM e a JOIN e b ON a.pc = 1 AND b.pc = 2
       UNION ALL SELECT 'spent', (SELECT sign(r) FROM f) * sqrt(a.eigenvalue / 2), -(SELECT sign(r) FROM f) * sqrt(b.eigenvalue / 2)
       FROM e a JOIN e b ON a.pc = 1 AND b.pc = 2""",
    TWO,
)
def pca_circle(spark, sf):
    return customer_fit(spark, sf)[1].circle()


@query("pca_scores", "o_custkey:int pc1:float6 pc2:float6", "SELECT * FROM s", TWO)
def pca_scores(spark, sf):
    matrix, fit = customer_fit(spark, sf)
    return fit.scores(matrix, ["o_custkey"])


@query(
    "pca_scores_grouped",
    "o_custkey:int pc1:float6 c_mktsegment:text",
    """SELECT s.o_custkey, pc1, coalesce(c_mktsegment, 'Unknown') AS c_mktsegment FROM s
       LEFT JOIN (SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS c_mktsegment FROM customer) ON s.o_custkey = c_custkey""",
    TWO,
)
def pca_scores_grouped(spark, sf):
    matrix, fit = customer_fit(spark, sf)
    segment = F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("c_mktsegment")
    mapping = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), segment)
    return multi.grouped_scores(fit.scores(matrix, ["o_custkey"]), mapping, "o_custkey", "c_mktsegment")


@query(
    "pca_extremes",
    "o_custkey:int dist:float6",
    "SELECT o_custkey, sqrt(pc1 * pc1 + pc2 * pc2) AS dist FROM s QUALIFY row_number() OVER (ORDER BY round(dist, 9) DESC, o_custkey) <= 10",
    TWO,
)
def pca_extremes(spark, sf):
    matrix, fit = customer_fit(spark, sf)
    return fit.extremes(matrix, "o_custkey")


@query(
    "pca_quality",
    "o_custkey:int quality:float6",
    "SELECT o_custkey, round((pc1 * pc1 + pc2 * pc2) / nullif(z1 * z1 + z2 * z2, 0), 3) AS quality FROM s",
    TWO,
)
def pca_quality(spark, sf):
    matrix, fit = customer_fit(spark, sf)
    return fit.quality(matrix, "o_custkey")


def supplier_fit(spark, sf) -> tuple:
    """Three features per supplier, whose components still have a closed form."""
    matrix = store(
        table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
            F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"),
            F.avg(F.round(F.col("l_tax") * 100)).alias("tax"),
        ),
        "supplier_matrix",
    )
    return matrix, fit_components(matrix, ["lines", "quantity", "tax"])


# The correlation matrix less its diagonal has eigenvalues mu with mu^3 - s mu - 2 p = 0; the
# cross product of two rows of the shifted matrix is an eigenvector.
THREE = """
m3 AS (SELECT l_suppkey, count(*) AS x1, sum(l_quantity) AS x2, avg(round(l_tax * 100)) AS x3 FROM lineitem GROUP BY 1),
f3 AS (SELECT count(*) AS n, corr(x1, x2) AS r12, corr(x1, x3) AS r13, corr(x2, x3) AS r23, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3,
              stddev_pop(x1) AS s1, stddev_pop(x2) AS s2, stddev_pop(x3) AS s3 FROM m3),
g3 AS (SELECT *, r12 * r12 + r13 * r13 + r23 * r23 AS s, r12 * r13 * r23 AS p FROM f3),
mu3 AS (SELECT pc, n, r12, r13, r23, 2 * sqrt(s / 3) * cos((acos(p / pow(s / 3, 1.5)) + CASE pc WHEN 1 THEN 0 WHEN 2 THEN -2 * pi() ELSE 2 * pi() END) / 3) AS mu
        FROM g3 CROSS JOIN (SELECT unnest([1, 2, 3]) AS pc)),
raw3 AS (SELECT pc, n, mu, r12 * r23 + r13 * mu AS w1, r12 * r13 + r23 * mu AS w2, mu * mu - r12 * r12 AS w3 FROM mu3),
unit3 AS (SELECT pc, n, mu, w1 / sqrt(w1 * w1 + w2 * w2 + w3 * w3) AS u1, w2 / sqrt(w1 * w1 + w2 * w2 + w3 * w3) AS u2,
                 w3 / sqrt(w1 * w1 + w2 * w2 + w3 * w3) AS u3 FROM raw3),
v3 AS (SELECT pc, (1 + mu) * n / (n - 1) AS eigenvalue, (1 + mu) / 3 AS ratio, u1 * flip AS v1, u2 * flip AS v2, u3 * flip AS v3 FROM (
         SELECT *, sign(CASE WHEN abs(u1) >= greatest(abs(u2), abs(u3)) - 1e-9 THEN u1 WHEN abs(u2) >= abs(u3) - 1e-9 THEN u2 ELSE u3 END) AS flip FROM unit3)),
z3 AS (SELECT l_suppkey, (x1 - f3.m1) / s1 AS z1, (x2 - f3.m2) / s2 AS z2, (x3 - f3.m3) / s3 AS z3 FROM m3 CROSS JOIN f3),
q3 AS (SELECT l_suppkey, pow(z1 * v1 + z2 * v2 + z3 * v3, 2) / nullif(z1 * z1 + z2 * z2 + z3 * z3, 0) AS cos2, pc FROM z3 CROSS JOIN v3 WHERE pc <= 2),
plane3 AS (SELECT l_suppkey, round(max(cos2) FILTER (WHERE pc = 1), 3) AS cos2_x, round(max(cos2) FILTER (WHERE pc = 2), 3) AS cos2_y,
                  round(sum(cos2), 3) AS quality FROM q3 GROUP BY 1)
"""


@query(
    "pca_eigen_three",
    "pc:int eigenvalue:float6 ratio:float6 cumulative:float6",
    "SELECT pc, eigenvalue, ratio, sum(ratio) OVER (ORDER BY pc) AS cumulative FROM v3",
    THREE,
)
def pca_eigen_three(spark, sf):
    return supplier_fit(spark, sf)[1].eigen()


@query(
    "pca_loadings_three",
    "feature:text pc:int loading:float6",
    """SELECT feature, pc, CASE feature WHEN 'lines' THEN v1 WHEN 'quantity' THEN v2 ELSE v3 END * sqrt(eigenvalue) AS loading
       FROM v3 CROSS JOIN (SELECT unnest(['lines', 'quantity', 'tax']) AS feature)""",
    THREE,
)
def pca_loadings_three(spark, sf):
    return supplier_fit(spark, sf)[1].loadings()


@query(
    "pca_quality_worst",
    "l_suppkey:int cos2_x:float6 cos2_y:float6 quality:float6",
    "SELECT * FROM plane3 ORDER BY quality NULLS LAST, l_suppkey LIMIT 20",
    THREE,
)
def pca_quality_worst(spark, sf):
    matrix, fit = supplier_fit(spark, sf)
    return fit.worst(matrix, "l_suppkey")


@query("pca_planes", "pc_x:int pc_y:int", """SELECT 1 AS pc_x, 2 AS pc_y UNION ALL SELECT 1, 3 WHERE (SELECT sum(ratio) FROM v3 WHERE pc <= 2) < 0.6""", THREE)
def pca_planes(spark, sf):
    return supplier_fit(spark, sf)[1].planes()


@query(
    "pca_matrix_area",
    "ZIPCODE:int EMS_Incident_Count:int EMS_Avg_Response_Time:float Fire_Incident_Count:int Fire_Avg_Response_Time:float",
    """SELECT coalesce(x.zip, y.zip) AS ZIPCODE, coalesce(x.n, 0) AS EMS_Incident_Count, x.r AS EMS_Avg_Response_Time,
         coalesce(y.n, 0) AS Fire_Incident_Count, y.r AS Fire_Avg_Response_Time
       FROM (SELECT c_nationkey AS zip, count(*) AS n, avg(floor(o_totalprice / 1000)) AS r FROM orders JOIN customer ON o_custkey = c_custkey
             WHERE c_nationkey <> 4 GROUP BY 1) x
       FULL JOIN (SELECT s_nationkey AS zip, count(*) AS n, avg(floor(l_extendedprice / 100)) AS r FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
             GROUP BY 1) y ON x.zip = y.zip""",
)
def pca_matrix_area(spark, sf):
    """Orders by the customer's nation, one nation's zip unknown, against lines by the supplier's."""
    orders = table(spark, sf, "orders").withColumn("response_time", F.floor(F.col("o_totalprice") / 1000).cast("double"))
    orders = multi.folded_responses(orders, "o_custkey").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf, "lineitem").withColumn("response_time", F.floor(F.col("l_extendedprice") / 100).cast("double"))
    lines = multi.folded_responses(lines, "l_suppkey").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    folded = ["n", "timed", "total"]
    return multi.area_matrix(
        orders.select(F.nullif("c_nationkey", F.lit(4)).alias("zipcode"), *folded), lines.select(F.col("s_nationkey").alias("zipcode"), *folded)
    )
