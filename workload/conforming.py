"""Conforming expressions, dimensions, facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions import numbers, text, times
from martloom.operators.keys import attach_key, dense_key
from martloom.plans import dimensions as dims
from martloom.plans import facts
from martloom.plans.staging import EMS_NEEDS, FIRE_NEEDS, LOCATION_COLUMNS, needed, stage_ems, stage_fire
from martloom.sources.raw import flatten_hourly
from martloom.storage import store
from workload import roles
from workload.registry import query, table
from workload.roles import A, B, DIMS, GALAXY, HOURLY, WIDE, date_key


@query(
    "conform_text",
    "c_custkey:int segment:text",
    "SELECT c_custkey, upper(trim(chr(9) || ' ' || lower(c_mktsegment) || chr(160) || chr(10), ' ' || chr(9) || chr(10) || chr(160))) AS segment FROM customer",
)
def conform_text(spark, sf):
    padded = F.concat(F.lit("\t "), F.lower("c_mktsegment"), F.lit(" \n"))
    return table(spark, sf, "customer").select("c_custkey", text.conform_text(padded).alias("segment"))


@query(
    "conform_value_map",
    "c_custkey:int region:text",
    """SELECT c_custkey, CASE r_name WHEN 'AMERICA' THEN 'AMERICAS' WHEN 'MIDDLE EAST' THEN 'ASIA' ELSE r_name END AS region
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def conform_value_map(spark, sf):
    placed = roles.with_place(table(spark, sf, "customer"), spark, sf, "c_nationkey")
    region = text.conform_values(F.concat(F.lit(" "), F.lower("rn")), {"AMERICA": "AMERICAS", "MIDDLE EAST": "ASIA"})
    return placed.select("c_custkey", region.alias("region"))


@query(
    "parse_datetime",
    "o_orderkey:int parsed:time",
    """SELECT o_orderkey, try_strptime(CASE WHEN o_orderkey % 7 = 0 THEN '02/30/2022 01:00:00 AM' WHEN o_orderkey % 7 = 1 THEN 'x'
         ELSE strftime(o_orderdate + to_minutes(o_custkey % 1440), '%m/%d/%Y %I:%M:%S %p') END, '%m/%d/%Y %I:%M:%S %p') AS parsed FROM orders""",
)
def parse_datetime(spark, sf):
    orders = table(spark, sf, "orders")
    at = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_custkey") % 1440).cast("int"))
    raw = (
        F.when(F.col("o_orderkey") % 7 == 0, "02/30/2022 01:00:00 AM")
        .when(F.col("o_orderkey") % 7 == 1, "x")
        .otherwise(F.date_format(at, roles.STAMP))
    )
    return orders.select("o_orderkey", times.parse_datetime(raw).alias("parsed"))


@query(
    "numeric_coerce",
    "o_orderkey:int whole:int measure:float",
    """SELECT o_orderkey,
         CASE o_orderkey % 10 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN 12345678905 WHEN 6 THEN o_custkey
              WHEN 7 THEN o_custkey WHEN 8 THEN NULL WHEN 9 THEN NULL ELSE o_custkey END AS whole,
         CASE o_orderkey % 10 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 4 THEN o_custkey + 0.5 WHEN 5 THEN 12345678905 WHEN 6 THEN o_custkey
              WHEN 7 THEN o_custkey WHEN 8 THEN 1e305 WHEN 9 THEN NULL ELSE o_custkey END AS measure FROM orders""",
)
def numeric_coerce(spark, sf):
    case, key = F.col("o_orderkey") % 10, F.col("o_custkey").cast("string")
    raw = (
        F.when(case == 0, F.concat(key, F.lit(".0")))
        .when(case == 1, F.concat(key, F.lit("d")))
        .when(case == 2, F.concat(key, F.lit(",0")))
        .when(case == 3, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(case == 5, F.lit("1234567890.5e1"))
        .when(case == 6, F.concat(key, F.lit("00e-2")))
        .when(case == 7, F.concat(key, F.lit(".0e0")))
        .when(case == 8, F.lit("1e305"))
        .when(case == 9, F.lit("1e400"))
        .otherwise(F.concat(key, F.lit(".5")))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", numbers.to_long(raw).alias("whole"), numbers.to_double(raw).alias("measure")
    )


@query(
    "clean_measure",
    "l_orderkey:int l_linenumber:int l_partkey:int seconds:float",
    """SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN floor(l_extendedprice / 80) - 50 >= 0 AND floor(l_extendedprice / 80) - 50 < 999
              THEN floor(l_extendedprice / 80) - 50 END AS seconds FROM lineitem""",
)
def clean_measure(spark, sf):
    raw = (F.floor(F.col("l_extendedprice") / 80) - 50).cast("string")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.clean_seconds(raw).alias("seconds")
    )


@query(
    "date_key",
    "event_id:int date_key:int hour:int",
    f"SELECT event_id, {date_key('ts')} AS date_key, hour(ts) AS hour FROM events",
)
def date_key_query(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", times.date_key(F.col("ts")).alias("date_key"), F.hour("ts").alias("hour")
    )


@query(
    "flag_recode",
    "l_orderkey:int l_linenumber:int flag:text",
    """SELECT l_orderkey, l_linenumber, CASE l_returnflag || l_linestatus WHEN 'NO' THEN '0' WHEN 'NF' THEN 'N F' WHEN 'AO' THEN '1'
         WHEN 'AF' THEN '0' WHEN 'RO' THEN '1' ELSE 'R' END AS flag FROM lineitem""",
)
def flag_recode(spark, sf):
    both = F.concat("l_returnflag", "l_linestatus")
    raw = (
        F.when(both == "NO", " n").when(both == "NF", "n f").when(both == "AO", "y")
        .when(both == "AF", "False ").when(both == "RO", "TRUE").otherwise("r")
    )
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.recode_flag(raw).alias("flag"))


@query(
    "staging",
    "incident_id:text incident_at:time scene_at:time zipcode:int borough:text date_key:int hour:int dispatch:float travel:float",
    f"""SELECT incident_id, dt AS incident_at, scene_dt AS scene_at, zip AS zipcode, borough, {date_key('dt')} AS date_key, hour(dt) AS hour,
         CASE WHEN dispatch_time < 999 THEN dispatch_time END AS dispatch, CASE WHEN travel_time < 999 THEN travel_time END AS travel FROM b""",
    B,
)
def staging(spark, sf):
    return stage_fire(roles.raw_b(spark, sf)).select(
        F.col("STARFIRE_INCIDENT_ID").alias("incident_id"),
        F.col("INCIDENT_DATETIME").alias("incident_at"),
        F.col("FIRST_ON_SCENE_DATETIME").alias("scene_at"),
        F.col("ZIPCODE").alias("zipcode"),
        F.col("BOROUGH_NORM").alias("borough"),
        F.col("DATE_KEY").alias("date_key"),
        F.col("HOUR").alias("hour"),
        F.col("DISPATCH_RESPONSE_SECONDS_QY_CLEAN").alias("dispatch"),
        F.col("INCIDENT_TRAVEL_TM_SECONDS_QY_CLEAN").alias("travel"),
    )


@query(
    "staging_a",
    "incident_id:text incident_at:time hospital_at:time zipcode:int borough:text council:int dispatch:float travel:float",
    """SELECT incident_id, dt AS incident_at, hospital_dt AS hospital_at, zip AS zipcode, borough, council,
         CASE WHEN dispatch_time >= 0 AND dispatch_time < 999 THEN dispatch_time END AS dispatch,
         CASE WHEN travel_time < 999 THEN travel_time END AS travel FROM a""",
    A,
)
def staging_a(spark, sf):
    return stage_ems(roles.raw_a(spark, sf)).select(
        F.col("CAD_INCIDENT_ID").alias("incident_id"),
        F.col("INCIDENT_DATETIME").alias("incident_at"),
        F.col("FIRST_HOSP_ARRIVAL_DATETIME").alias("hospital_at"),
        F.col("ZIPCODE").alias("zipcode"),
        F.col("BOROUGH_NORM").alias("borough"),
        F.col("CITYCOUNCILDISTRICT").alias("council"),
        F.col("DISPATCH_RESPONSE_SECONDS_QY_CLEAN").alias("dispatch"),
        F.col("INCIDENT_TRAVEL_TM_SECONDS_QY_CLEAN").alias("travel"),
    )


@query(
    "surrogate_key",
    "customer_key:int c_nationkey:int c_mktsegment:text",
    """SELECT row_number() OVER (ORDER BY c_nationkey NULLS LAST, c_mktsegment) AS customer_key, c_nationkey, c_mktsegment
       FROM (SELECT DISTINCT nullif(c_nationkey, 3) AS c_nationkey, c_mktsegment FROM customer)""",
)
def surrogate_key(spark, sf):
    rows = table(spark, sf, "customer").select(F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"), "c_mktsegment")
    return dense_key(rows.distinct(), "customer_key", ["c_nationkey", "c_mktsegment"])


CALENDAR = f"""day AS date, {date_key('day')} AS date_key, year(day) AS year, month(day) AS month, day(day) AS day, isodow(day) AS day_of_week,
  dayname(day) AS day_name, CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS is_weekend, week(day) AS week, quarter(day) AS quarter,
  year(day) + CASE WHEN month(day) >= 7 THEN 1 ELSE 0 END AS fiscal_year,
  CASE WHEN month(day) IN (12, 1, 2) THEN 'Winter' WHEN month(day) <= 5 THEN 'Spring' WHEN month(day) <= 8 THEN 'Summer' ELSE 'Fall' END AS season"""
CALENDAR_SPEC = (
    "date:day date_key:int year:int month:int day:int day_of_week:int day_name:text is_weekend:int "
    "quarter:int fiscal_year:int season:text"
)


@query(
    "dim_time",
    CALENDAR_SPEC,
    f"SELECT {CALENDAR} FROM (SELECT CAST(dt AS DATE) AS day FROM a UNION SELECT CAST(dt AS DATE) FROM b) WHERE day IS NOT NULL",
    f"{A}, {B}",
)
def dim_time(spark, sf):
    return dims.dim_time([stage_ems(roles.raw_a(spark, sf)), stage_fire(roles.raw_b(spark, sf))])


@query(
    "dim_time_multi",
    CALENDAR_SPEC + " week:int",
    f"""SELECT {CALENDAR} FROM (SELECT CAST(dt AS DATE) AS day FROM a UNION SELECT CAST(assigned_dt AS DATE) FROM a
        UNION SELECT CAST(hospital_dt AS DATE) FROM a UNION SELECT CAST(dt AS DATE) FROM b UNION SELECT CAST(scene_dt AS DATE) FROM b)
        WHERE day IS NOT NULL""",
    f"{A}, {B}",
)
def dim_time_multi(spark, sf):
    return dims.dim_time_wide([stage_ems(roles.raw_a(spark, sf)), stage_fire(roles.raw_b(spark, sf))])


@query(
    "dim_location",
    "location_key:int zipcode:int borough:text",
    "SELECT * FROM dim_location",
    GALAXY,
)
def dim_location(spark, sf):
    return dims.dim_location([stage_ems(roles.raw_a(spark, sf)), stage_fire(roles.raw_b(spark, sf))])


@query(
    "dim_location_wide",
    "location_key:int BOROUGH_NORM:text ZIPCODE:int POLICEPRECINCT:int CITYCOUNCILDISTRICT:int COMMUNITYDISTRICT:int "
    "COMMUNITYSCHOOLDISTRICT:int CONGRESSIONALDISTRICT:int",
    """SELECT location_key, borough AS BOROUGH_NORM, zip AS ZIPCODE, precinct AS POLICEPRECINCT, council AS CITYCOUNCILDISTRICT,
       community AS COMMUNITYDISTRICT, school AS COMMUNITYSCHOOLDISTRICT, congress AS CONGRESSIONALDISTRICT FROM dim_wide""",
    f"{A}, {B}, {WIDE}",
)
def dim_location_wide(spark, sf):
    return dims.dim_location_wide([stage_ems(roles.raw_a(spark, sf)), stage_fire(roles.raw_b(spark, sf))])


SITES = """
sites AS (
  SELECT s_name AS firehouse_name, CASE WHEN s_suppkey % 9 <> 0 THEN 10000 + n_nationkey END AS zipcode, r_name AS borough,
         n_name || ' street' AS address, s_acctbal / 1000 AS latitude, CAST(n_nationkey AS DOUBLE) AS longitude, r_regionkey AS board
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)
"""


@query(
    "dim_site",
    "firehouse_key:int firehouse_name:text zipcode:int borough:text FacilityAddress:text Latitude:float Longitude:float",
    """SELECT row_number() OVER (ORDER BY firehouse_name, zipcode NULLS LAST, borough, address, latitude, longitude) AS firehouse_key,
         firehouse_name, zipcode, borough, address AS FacilityAddress, latitude AS Latitude, longitude AS Longitude
       FROM (SELECT DISTINCT * FROM sites)""",
    SITES,
)
def dim_site(spark, sf):
    return dims.dim_site(roles.raw_sites(spark, sf))


@query(
    "dim_site_wide",
    "firehouse_key:int FacilityName:text Postcode:int Borough_Norm:text Latitude:text Longitude:text board:text",
    """SELECT row_number() OVER (ORDER BY firehouse_name) AS firehouse_key, firehouse_name AS FacilityName, zipcode AS Postcode,
         borough AS Borough_Norm, latitude AS Latitude, CAST(CAST(longitude AS INTEGER) AS VARCHAR) AS Longitude, board
       FROM (SELECT DISTINCT * FROM sites)""",
    SITES,
)
def dim_site_wide(spark, sf):
    return dims.dim_site_wide(roles.raw_sites(spark, sf)).withColumnRenamed("Community Board", "board")


@query(
    "bridge_area_site",
    "firehouse_key:int ZIPCODE:int BOROUGH_NORM:text",
    """SELECT * FROM (SELECT row_number() OVER (ORDER BY firehouse_name) AS firehouse_key, zipcode AS ZIPCODE, borough AS BOROUGH_NORM
         FROM (SELECT DISTINCT * FROM sites)) WHERE ZIPCODE IS NOT NULL""",
    SITES,
)
def bridge_area_site(spark, sf):
    return dims.bridge_area_site(dims.dim_site_wide(roles.raw_sites(spark, sf)))


@query(
    "dim_incident_type",
    "incident_type_key:int type_code:text source:text category:text",
    "SELECT * FROM dim_type",
    GALAXY,
)
def dim_incident_type(spark, sf):
    return dims.dim_incident_type(stage_ems(roles.raw_a(spark, sf)), stage_fire(roles.raw_b(spark, sf)))


@query(
    "dim_weather",
    "weather_key:int date_key:int hour:int temp_f:float precip_in:float wind_mph:float weather_code:int is_raining:int is_hot:int is_cold:int",
    "SELECT * FROM dim_weather",
    GALAXY,
)
def dim_weather(spark, sf):
    return dims.dim_weather(roles.raw_weather(spark, sf))


@query(
    "dim_code",
    "priority_key:int o_orderpriority:text",
    """SELECT row_number() OVER (ORDER BY p) AS priority_key, p AS o_orderpriority FROM (SELECT DISTINCT upper(o_orderpriority) AS p FROM orders)""",
)
def dim_code(spark, sf):
    padded = table(spark, sf, "orders").select(F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("o_orderpriority"))
    return dims.code_dim(padded, "o_orderpriority", "priority_key")


CODES = """
codes AS (
  SELECT DISTINCT * FROM (
    SELECT 'dim_ems_initial_call_type' AS dim, upper(initial_call_type) AS code FROM a
    UNION ALL SELECT 'dim_ems_final_call_type', upper(final_call_type) FROM a
    UNION ALL SELECT 'dim_ems_initial_severity', initial_severity FROM a
    UNION ALL SELECT 'dim_ems_final_severity', final_severity FROM a
    UNION ALL SELECT 'dim_ems_disposition', upper(disposition) FROM a
    UNION ALL SELECT 'dim_fire_class_group', grp FROM b
    UNION ALL SELECT 'dim_fire_class', class FROM b
    UNION ALL SELECT 'dim_fire_alarm_source', alarm_source FROM b
    UNION ALL SELECT 'dim_fire_alarm_level', alarm_level FROM b)
  WHERE code IS NOT NULL),
numbered AS (SELECT dim, code, row_number() OVER (PARTITION BY dim ORDER BY code) AS code_key FROM codes)
"""


def all_codes(a, b):
    return dims.code_dims([(a, dims.EMS_CODE_DIMS), (b, dims.FIRE_CODE_DIMS)])


@query(
    "dim_codes_all",
    "dim:text code_key:int code:text",
    "SELECT * FROM numbered",
    f"{A}, {B}, {CODES}",
)
def dim_codes_all(spark, sf):
    built = all_codes(stage_ems(roles.raw_a(spark, sf)), stage_fire(roles.raw_b(spark, sf)))
    parts = [df.toDF("code_key", "code").withColumn("dim", F.lit(name)) for name, df in built.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "area_mode_mapping",
    "c_nationkey:int c_mktsegment:text",
    """SELECT c_nationkey, c_mktsegment FROM (SELECT c_nationkey, c_mktsegment,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) AS r FROM customer GROUP BY 1, 2) WHERE r = 1""",
)
def area_mode_mapping(spark, sf):
    return dims.area_mode(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment")


@query(
    "area_mapping",
    "ZIPCODE:int BOROUGH:text",
    """SELECT zip AS ZIPCODE, borough AS BOROUGH FROM (SELECT zip, borough, row_number() OVER (PARTITION BY zip ORDER BY count(*) DESC, borough) AS r
         FROM a WHERE zip IS NOT NULL AND borough IS NOT NULL GROUP BY 1, 2) WHERE r = 1""",
    A,
)
def area_mapping(spark, sf):
    return dims.area_mapping(stage_ems(roles.raw_a(spark, sf)))


@query(
    "attach_location_key",
    "incident_id:text location_key:int",
    """SELECT incident_id, location_key FROM b LEFT JOIN dim_location d
       ON b.zip IS NOT DISTINCT FROM d.zipcode AND b.borough IS NOT DISTINCT FROM d.borough""",
    GALAXY,
)
def attach_location_key(spark, sf):
    b = store(needed(stage_fire(roles.raw_b(spark, sf)), ["STARFIRE_INCIDENT_ID", *PLACE]), "staged_b")
    location = dims.dim_location([needed(stage_ems(roles.raw_a(spark, sf)), PLACE), b])
    on = [("ZIPCODE", "zipcode"), ("BOROUGH_NORM", "borough")]
    keyed = attach_key(b, location, on, "location_key", null_safe=True)
    return keyed.select(F.col("STARFIRE_INCIDENT_ID").alias("incident_id"), "location_key")


@query(
    "attach_large_lookup",
    "l_orderkey:int l_linenumber:int order_ref:int customer:int",
    """SELECT l_orderkey, l_linenumber, order_ref, o_custkey AS customer FROM (
         SELECT *, CASE l_returnflag WHEN 'N' THEN (SELECT min(o_orderkey) FROM orders) WHEN 'A' THEN l_orderkey END AS order_ref
         FROM lineitem) LEFT JOIN orders ON order_ref = o_orderkey""",
)
def attach_large_lookup(spark, sf):
    """A lookup joined by shuffle to rows of which many share one key and many have none."""
    orders = table(spark, sf, "orders")
    first = orders.agg(F.min("o_orderkey")).scalar()
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "N", first).when(F.col("l_returnflag") == "A", F.col("l_orderkey")).alias("order_ref"),
    )
    lookup = orders.select("o_orderkey", F.col("o_custkey").alias("customer"))
    return attach_key(lines, lookup, [("order_ref", "o_orderkey")], "customer", broadcast_rows=0)


WIDE_MATCH = " AND ".join(
    f"x.{c} IS NOT DISTINCT FROM d.{c}" for c in ("borough", "zip", "precinct", "council", "community", "school", "congress")
)


@query(
    "attach_location_key_wide",
    "incident_id:int location_key:int",
    f"SELECT incident_id, location_key FROM a x LEFT JOIN dim_wide d ON {WIDE_MATCH}",
    f"{A}, {B}, {WIDE}",
)
def attach_location_key_wide(spark, sf):
    a = store(needed(stage_ems(roles.raw_a(spark, sf)), ["CAD_INCIDENT_ID", *LOCATION_COLUMNS]), "staged_a")
    location = dims.dim_location_wide([a, needed(stage_fire(roles.raw_b(spark, sf)), LOCATION_COLUMNS)])
    keyed = facts.attach_location_wide(a, location)
    return keyed.select(F.col("CAD_INCIDENT_ID").alias("incident_id"), "location_key")


@query(
    "attach_dim_key",
    "o_orderkey:int priority_key:int",
    """SELECT o_orderkey, priority_key FROM orders LEFT JOIN
         (SELECT p, row_number() OVER (ORDER BY p) AS priority_key FROM (SELECT DISTINCT nullif(o_orderpriority, '5-LOW') AS p FROM orders) WHERE p IS NOT NULL)
       ON o_orderpriority = p""",
)
def attach_dim_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    known = orders.select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"))
    dim = dims.code_dim(known, "o_orderpriority", "priority_key")
    return facts.attach_code(orders, dim, "o_orderpriority", "priority_key").select("o_orderkey", "priority_key")


# What the dimensions that both facts share take from a source.
PLACE = ["ZIPCODE", "BOROUGH_NORM"]
A_SHARED, B_SHARED = [*PLACE, "FINAL_CALL_TYPE"], [*PLACE, "INCIDENT_CLASSIFICATION", "INCIDENT_CLASSIFICATION_GROUP"]


def galaxy_parts(spark, sf, a_needs=EMS_NEEDS, b_needs=FIRE_NEEDS):
    """Staged frames, each built and parsed once, and the dimensions both facts share."""
    a = store(needed(stage_ems(roles.raw_a(spark, sf)), a_needs), "staged_a")
    b = store(needed(stage_fire(roles.raw_b(spark, sf)), b_needs), "staged_b")
    return a, b, dims.dim_location([a, b]), dims.dim_incident_type(a, b), dims.dim_weather(roles.raw_weather(spark, sf))


SHARED_KEYS = f"""
  LEFT JOIN dim_location d ON x.zip IS NOT DISTINCT FROM d.zipcode AND x.borough IS NOT DISTINCT FROM d.borough
  LEFT JOIN dim_weather w ON {date_key('x.dt')} = w.date_key AND hour(x.dt) = w.hour"""


@query(
    "fact_a",
    "incident_id:int date_key:int hour:int location_key:int incident_type_key:int weather_key:int dispatch_time:float "
    "travel_time:float response_time:float nb_interventions:int initial_call_type:text final_call_type:text",
    f"""SELECT x.incident_id, {date_key('x.dt')} AS date_key, hour(x.dt) AS hour, location_key, incident_type_key, weather_key,
         dispatch_time, travel_time, response_time, 1 AS nb_interventions, initial_call_type, final_call_type
       FROM a x {SHARED_KEYS} LEFT JOIN dim_type t ON t.source = 'EMS' AND t.type_code = x.final_call_type""",
    GALAXY,
)
def fact_a(spark, sf):
    a, _, location, types, weather = galaxy_parts(spark, sf, b_needs=B_SHARED)
    return facts.fact_ems(a, location, types, weather)


@query(
    "fact_b",
    "incident_id:text date_key:int hour:int location_key:int incident_type_key:int weather_key:int engines_assigned_quantity:int "
    "ladders_assigned_quantity:int other_units_assigned_quantity:int total_units:int dispatch_time:float travel_time:float "
    "response_time:float total_duration:float nb_interventions:int",
    f"""SELECT x.incident_id, {date_key('x.dt')} AS date_key, hour(x.dt) AS hour, location_key, incident_type_key, weather_key,
         engines AS engines_assigned_quantity, ladders AS ladders_assigned_quantity, coalesce(others, 0) AS other_units_assigned_quantity,
         engines + ladders + coalesce(others, 0) AS total_units, dispatch_time, travel_time, response_time, duration AS total_duration,
         1 AS nb_interventions
       FROM b x {SHARED_KEYS} LEFT JOIN dim_type t ON t.source = 'FIRE' AND t.type_code = x.class""",
    GALAXY,
)
def fact_b(spark, sf):
    _, b, location, types, weather = galaxy_parts(spark, sf, a_needs=A_SHARED)
    return facts.fact_fire(b, location, types, weather)


@query(
    "fact_union",
    "source:text date_key:int location_key:int n:int response:float",
    f"""SELECT source, date_key, location_key, count(*) AS n, sum(response_time) AS response FROM (
         SELECT 'EMS' AS source, {date_key('x.dt')} AS date_key, location_key, response_time FROM a x {SHARED_KEYS}
         UNION ALL SELECT 'FIRE', {date_key('x.dt')}, location_key, response_time FROM b x {SHARED_KEYS}) GROUP BY 1, 2, 3""",
    GALAXY,
)
def fact_union(spark, sf):
    a, b, location, types, weather = galaxy_parts(spark, sf)
    both = {"EMS": facts.fact_ems(a, location, types, weather), "FIRE": facts.fact_fire(b, location, types, weather)}
    stacked = facts.combined(both, ["date_key", "location_key", "nb_interventions", "response_time"])
    return stacked.groupBy("source", "date_key", "location_key").agg(
        F.sum("nb_interventions").alias("n"), F.sum("response_time").alias("response")
    )


def star_parts(spark, sf, a_needs, b_needs):
    """Staged frames with what is needed of each, and the locations of both."""
    a = store(needed(stage_ems(roles.raw_a(spark, sf)), a_needs), "staged_a")
    b = store(needed(stage_fire(roles.raw_b(spark, sf)), b_needs), "staged_b")
    return a, b, dims.dim_location_wide([a, b])


def code_join(alias: str, dim: str, code: str) -> str:
    return f" LEFT JOIN numbered {alias} ON {alias}.dim = '{dim}' AND {alias}.code = {code}"


STAR_A_JOINS = "".join(
    [
        code_join("c1", "dim_ems_initial_call_type", "upper(x.initial_call_type)"),
        code_join("c2", "dim_ems_final_call_type", "upper(x.final_call_type)"),
        code_join("c3", "dim_ems_initial_severity", "x.initial_severity"),
        code_join("c4", "dim_ems_final_severity", "x.final_severity"),
        code_join("c5", "dim_ems_disposition", "upper(x.disposition)"),
    ]
)


@query(
    "star_fact_a",
    "ems_incident_id:int incident_datetime:time incident_date_key:int location_key:int dispatch_response_seconds_qy_seconds:float "
    "incident_response_seconds_qy_seconds:float incident_travel_tm_seconds_qy_seconds:float ems_initial_call_type_key:int "
    "ems_final_call_type_key:int ems_initial_severity_key:int ems_final_severity_key:int ems_disposition_key:int "
    "held_indicator:text reopen_indicator:text",
    f"""SELECT incident_id AS ems_incident_id, dt AS incident_datetime, {date_key('dt')} AS incident_date_key, location_key,
         CASE WHEN dispatch_time >= 0 AND dispatch_time < 999 THEN dispatch_time END AS dispatch_response_seconds_qy_seconds,
         CASE WHEN response_time < 999 THEN response_time END AS incident_response_seconds_qy_seconds,
         CASE WHEN travel_time < 999 THEN travel_time END AS incident_travel_tm_seconds_qy_seconds,
         c1.code_key AS ems_initial_call_type_key, c2.code_key AS ems_final_call_type_key, c3.code_key AS ems_initial_severity_key,
         c4.code_key AS ems_final_severity_key, c5.code_key AS ems_disposition_key, held AS held_indicator, reopen AS reopen_indicator
       FROM a x LEFT JOIN dim_wide d ON {WIDE_MATCH} {STAR_A_JOINS}""",
    f"{A}, {B}, {WIDE}, {CODES}",
)
def star_fact_a(spark, sf):
    a, _, location = star_parts(spark, sf, facts.STAR_EMS_NEEDS, LOCATION_COLUMNS)
    return facts.star_fact_ems(a, location, dims.code_dims([(a, dims.EMS_CODE_DIMS)]))


STAR_B_JOINS = "".join(
    [
        code_join("c1", "dim_fire_class_group", "x.grp"),
        code_join("c2", "dim_fire_class", "x.class"),
        code_join("c3", "dim_fire_alarm_source", "x.alarm_source"),
        code_join("c4", "dim_fire_alarm_level", "x.alarm_level"),
    ]
)


@query(
    "star_fact_b",
    "fire_incident_id:text incident_datetime:time incident_date_key:int location_key:int dispatch_response_seconds_qy_seconds:float "
    "incident_response_seconds_qy_seconds:float incident_travel_tm_seconds_qy_seconds:float engines_assigned_quantity:int "
    "ladders_assigned_quantity:int other_units_assigned_quantity:int fire_class_group_key:int fire_class_key:int "
    "fire_alarm_source_key:int fire_alarm_level_key:int alarm_box_borough:text highest_alarm_level:text",
    f"""SELECT incident_id AS fire_incident_id, dt AS incident_datetime, {date_key('dt')} AS incident_date_key, location_key,
         CASE WHEN dispatch_time < 999 THEN dispatch_time END AS dispatch_response_seconds_qy_seconds,
         CASE WHEN response_time < 999 THEN response_time END AS incident_response_seconds_qy_seconds,
         CASE WHEN travel_time < 999 THEN travel_time END AS incident_travel_tm_seconds_qy_seconds,
         engines AS engines_assigned_quantity, ladders AS ladders_assigned_quantity, others AS other_units_assigned_quantity,
         c1.code_key AS fire_class_group_key, c2.code_key AS fire_class_key, c3.code_key AS fire_alarm_source_key,
         c4.code_key AS fire_alarm_level_key, box_borough AS alarm_box_borough, highest AS highest_alarm_level
       FROM b x LEFT JOIN dim_wide d ON {WIDE_MATCH} {STAR_B_JOINS}""",
    f"{A}, {B}, {WIDE}, {CODES}",
)
def star_fact_b(spark, sf):
    _, b, location = star_parts(spark, sf, LOCATION_COLUMNS, facts.STAR_FIRE_NEEDS)
    return facts.star_fact_fire(b, location, dims.code_dims([(b, dims.FIRE_CODE_DIMS)]))


@query(
    "weather_json_flatten",
    "time:text temperature_2m:float precipitation:float windspeed_10m:int",
    "SELECT strftime(h, '%Y-%m-%dT%H:%M') AS time, temp AS temperature_2m, precip AS precipitation, wind AS windspeed_10m FROM hours",
    HOURLY,
)
def weather_json_flatten(spark, sf):
    """Hourly rows folded into one response per day, at most 24 entries each, and flattened again."""
    entry = F.struct(
        F.date_format("h", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.col("temp").alias("temperature_2m"),
        F.col("precip").alias("precipitation"),
        F.col("wind").alias("windspeed_10m"),
    )
    days = roles.hourly_events(spark, sf).groupBy(F.to_date("h").alias("day")).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    fields = ("time", "temperature_2m", "precipitation", "windspeed_10m")
    responses = days.select(F.struct(*[F.col(f"e.{f}").alias(f) for f in fields]).alias("hourly"))
    return flatten_hourly(responses)
