"""The given tables in the roles of raw incident files, and the same roles in SQL.

Source A is `events` placed by the user's customer record, source B is `lineitem` placed by its
supplier, the site list is `supplier`, the hourly weather is folded from `events`. Text is made
as untidy as real files: padding, case, null tokens, '.0' suffixes, broken dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.times import date_key as calendar_key
from workload.registry import table

STAMP = "MM/dd/yyyy hh:mm:ss a"


def text(c: Column) -> Column:
    return c.cast("string")


def later(ts: str, days: Column | None = None, hours: Column | None = None) -> Column:
    zero = F.lit(0)
    return F.col(ts) + F.make_dt_interval(zero if days is None else days.cast("int"), zero if hours is None else hours.cast("int"))


def placed_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.floor(F.col("value") * 4).alias("v"),
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("seg"))
    out = events.join(customer, events.user_id == customer.c_custkey, "left")
    return with_place(out, spark, sf, "c_nationkey")


def with_place(df: DataFrame, spark: SparkSession, sf: str, nation_key: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nk"), F.col("n_regionkey").alias("rk"), "n_name")
    region = table(spark, sf, "region").select("r_regionkey", F.col("r_name").alias("rn"))
    return (
        df.join(nation, F.col(nation_key) == F.col("nk"), "left")
        .join(region, F.col("rk") == F.col("r_regionkey"), "left")
    )


def raw_a(spark: SparkSession, sf: str) -> DataFrame:
    k, event = F.col("k"), F.col("event_type")
    zip_text = text(F.col("nk") + 10000)
    return placed_events(spark, sf).select(
        text(F.col("event_id")).alias("CAD_INCIDENT_ID"),
        F.when(k == 13, "not known").otherwise(F.date_format("ts", STAMP)).alias("INCIDENT_DATETIME"),
        F.date_format(later("ts", hours=k), STAMP).alias("FIRST_ASSIGNMENT_DATETIME"),
        F.date_format(later("ts", days=k), STAMP).alias("FIRST_HOSP_ARRIVAL_DATETIME"),
        F.when(k % 10 == 0, "NA")
        .when(k % 10 == 1, F.concat(zip_text, F.lit(".0")))
        .when(k % 10 == 2, F.concat(F.lit(" "), zip_text, F.lit(" ")))
        .when(k % 10 == 3, F.concat(F.lit("x"), zip_text))
        .otherwise(zip_text)
        .alias("ZIPCODE"),
        F.when(k % 7 == 0, "")
        .when(k % 7 == 1, "\tRichmond / Staten Island ")
        .otherwise(F.concat(F.lit(" "), F.lower("rn"), F.lit("\t")))
        .alias("BOROUGH"),
        text(F.col("nk") % 7).alias("POLICEPRECINCT"),
        F.when(k % 6 == 0, "n/a").otherwise(text(F.col("rk"))).alias("CITYCOUNCILDISTRICT"),
        F.concat(text(F.col("nk") % 3), F.lit(".0")).alias("COMMUNITYDISTRICT"),
        text(F.col("rk")).alias("CONGRESSIONALDISTRICT"),
        event.alias("INITIAL_CALL_TYPE"),
        F.when(k % 4 == 0, F.col("seg")).when(k == 7, "NULL").otherwise(event).alias("FINAL_CALL_TYPE"),
        text(k % 8).alias("INITIAL_SEVERITY_LEVEL_CODE"),
        F.concat(F.lit(" "), text(k % 5)).alias("FINAL_SEVERITY_LEVEL_CODE"),
        F.lower("seg").alias("INCIDENT_DISPOSITION_CODE"),
        F.when(k == 50, "-1").when(k == 51, "1,000").otherwise(text(F.col("v"))).alias("DISPATCH_RESPONSE_SECONDS_QY"),
        F.when(k % 20 == 5, "n/a").otherwise(text(k * 10)).alias("INCIDENT_TRAVEL_TM_SECONDS_QY"),
        F.concat(text(F.col("v") + k * 10), F.lit(".0")).alias("INCIDENT_RESPONSE_SECONDS_QY"),
        F.when(event == "click", "Y").when(event == "view", "n").when(event == "error", " true")
        .when(event == "signup", "False").otherwise("maybe").alias("HELD_INDICATOR"),
        F.when(k % 2 == 0, "1").otherwise("N").alias("REOPEN_INDICATOR"),
    )


def raw_b(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("tax", F.round(F.col("l_tax") * 100).cast("int"))
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    placed = with_place(lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left"), spark, sf, "s_nationkey")
    line, flag, quantity = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_quantity")
    dispatch, travel = F.floor(F.col("l_extendedprice") / 100), F.floor(F.col("l_extendedprice") / 250)
    group = F.concat(flag, F.when(F.col("tax") <= 3, " LOW").otherwise(" HIGH"))
    return placed.select(
        F.concat_ws("-", text(F.col("l_orderkey")), text(line)).alias("STARFIRE_INCIDENT_ID"),
        F.date_format(later("l_shipdate", hours=F.col("l_partkey") % 24), STAMP).alias("INCIDENT_DATETIME"),
        F.date_format(later("l_shipdate", days=line), STAMP).alias("FIRST_ON_SCENE_DATETIME"),
        text(F.col("nk") + 10000).alias("ZIPCODE"),
        F.when(line == 7, "null").when(line == 6, "richmond").otherwise(F.col("rn")).alias("INCIDENT_BOROUGH"),
        text(F.col("nk") % 7).alias("POLICEPRECINCT"),
        text(F.col("rk")).alias("CITYCOUNCILDISTRICT"),
        text(F.col("nk") % 2).alias("COMMUNITYSCHOOLDISTRICT"),
        F.when(quantity == 50, "#N/A").otherwise(F.concat_ws("-", flag, text(F.col("tax")))).alias("INCIDENT_CLASSIFICATION"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("ZZ "), group)).otherwise(group).alias("INCIDENT_CLASSIFICATION_GROUP"),
        text(quantity.cast("int")).alias("ENGINES_ASSIGNED_QUANTITY"),
        text(line).alias("LADDERS_ASSIGNED_QUANTITY"),
        F.when(flag != "N", text(F.round(F.col("l_discount") * 100).cast("int"))).alias("OTHER_UNITS_ASSIGNED_QUANTITY"),
        text(dispatch).alias("DISPATCH_RESPONSE_SECONDS_QY"),
        text(travel).alias("INCIDENT_TRAVEL_TM_SECONDS_QY"),
        text(dispatch + travel).alias("INCIDENT_RESPONSE_SECONDS_QY"),
        text(quantity * 100).alias("TOTAL_INCIDENT_DURATION_SECONDS"),
        F.lower(flag).alias("ALARM_SOURCE_DESCRIPTION_TX"),
        F.col("l_linestatus").alias("ALARM_LEVEL_INDEX_DESCRIPTION"),
        F.col("rn").alias("ALARM_BOX_BOROUGH"),
        F.concat(F.lit("level "), text(line)).alias("HIGHEST_ALARM_LEVEL"),
    )


def raw_sites(spark: SparkSession, sf: str) -> DataFrame:
    placed = with_place(table(spark, sf, "supplier"), spark, sf, "s_nationkey")
    return placed.select(
        F.col("s_name").alias("FacilityName"),
        F.concat("n_name", F.lit(" street")).alias("FacilityAddress"),
        F.concat(F.lit(" "), F.lower("rn")).alias("Borough"),
        F.when(F.col("s_suppkey") % 9 == 0, "N/A").otherwise(F.concat(text(F.col("nk") + 10000), F.lit(".0"))).alias("Postcode"),
        text(F.col("s_acctbal") / 1000).alias("Latitude"),
        text(F.col("nk")).alias("Longitude"),
        text(F.col("rk")).alias("Community Board"),
    )


def hourly_events(spark: SparkSession, sf: str) -> DataFrame:
    """(h, temp, precip, wind): one row per hour that has events."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    return (
        table(spark, sf, "events")
        .groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"))
        .agg(
            F.avg(F.floor(F.col("value") * 4) / 4).alias("temp"),
            F.sum(F.when(F.col("event_type") == "error", 0.25).otherwise(0.0)).alias("precip"),
            F.max(k).alias("wind"),
        )
    )


def raw_weather(spark: SparkSession, sf: str) -> DataFrame:
    return hourly_events(spark, sf).select(
        F.date_format("h", "yyyy-MM-dd'T'HH:mm").alias("time"),
        text(F.col("temp")).alias("temperature_2m"),
        text(F.col("precip")).alias("precipitation"),
        text(F.col("wind") % 4).alias("weathercode"),
        text(F.col("wind")).alias("windspeed_10m"),
    )


A = """
a0 AS (
  SELECT e.event_id, e.ts, e.event_type, CAST(floor(e.value * 4) AS BIGINT) AS v,
         CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) AS k, c.c_mktsegment AS seg,
         n.n_nationkey AS nk, n.n_regionkey AS rk, r.r_name AS rn
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
a AS (
  SELECT event_id AS incident_id,
         CASE WHEN k <> 13 THEN date_trunc('second', ts) END AS dt,
         date_trunc('second', ts) + to_hours(k) AS assigned_dt,
         date_trunc('second', ts) + to_days(k) AS hospital_dt,
         CASE WHEN k % 10 NOT IN (0, 3) THEN 10000 + nk END AS zip,
         CASE WHEN k % 7 = 0 THEN NULL WHEN k % 7 = 1 THEN 'STATEN ISLAND' ELSE rn END AS borough,
         nk % 7 AS precinct, CASE WHEN k % 6 <> 0 THEN rk END AS council, nk % 3 AS community,
         CAST(NULL AS INTEGER) AS school, rk AS congress,
         event_type AS initial_call_type,
         CASE WHEN k % 4 = 0 THEN seg WHEN k = 7 THEN NULL ELSE event_type END AS final_call_type,
         CAST(k % 8 AS VARCHAR) AS initial_severity, CAST(k % 5 AS VARCHAR) AS final_severity, seg AS disposition,
         CASE WHEN k = 50 THEN -1 WHEN k = 51 THEN NULL ELSE v END AS dispatch_time,
         CASE WHEN k % 20 <> 5 THEN k * 10 END AS travel_time,
         v + k * 10 AS response_time,
         CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '0' WHEN 'error' THEN '1'
              WHEN 'signup' THEN '0' ELSE 'MAYBE' END AS held,
         CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS reopen
  FROM a0)
"""

B = """
b0 AS (
  SELECT l.*, CAST(round(l_tax * 100) AS INTEGER) AS tax, n.n_nationkey AS nk, n.n_regionkey AS rk, r.r_name AS rn,
         CAST(floor(l_extendedprice / 100) AS BIGINT) AS d, CAST(floor(l_extendedprice / 250) AS BIGINT) AS t
  FROM lineitem l
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
b AS (
  SELECT l_orderkey || '-' || l_linenumber AS incident_id,
         l_shipdate + to_hours(l_partkey % 24) AS dt,
         l_shipdate + to_days(l_linenumber) AS scene_dt,
         10000 + nk AS zip,
         CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 'STATEN ISLAND' ELSE rn END AS borough,
         nk % 7 AS precinct, rk AS council, CAST(NULL AS INTEGER) AS community, nk % 2 AS school,
         CAST(NULL AS INTEGER) AS congress,
         CASE WHEN l_quantity <> 50 THEN l_returnflag || '-' || tax END AS class,
         CASE WHEN l_linestatus = 'O' THEN 'ZZ ' ELSE '' END || l_returnflag
           || CASE WHEN tax <= 3 THEN ' LOW' ELSE ' HIGH' END AS grp,
         CAST(l_quantity AS INTEGER) AS engines, l_linenumber AS ladders,
         CASE WHEN l_returnflag <> 'N' THEN CAST(round(l_discount * 100) AS INTEGER) END AS others,
         d AS dispatch_time, t AS travel_time, d + t AS response_time, l_quantity * 100 AS duration,
         upper(l_returnflag) AS alarm_source, l_linestatus AS alarm_level, rn AS box_borough,
         'level ' || l_linenumber AS highest
  FROM b0)
"""

HOURLY = """
hours AS (
  SELECT date_trunc('hour', ts) AS h, avg(floor(value * 4) / 4) AS temp,
         sum(CASE WHEN event_type = 'error' THEN 0.25 ELSE 0.0 END) AS precip,
         max(CAST(regexp_extract(props, '[0-9]+') AS INTEGER)) AS wind
  FROM events GROUP BY 1)
"""


def date_key(ts: str) -> str:
    return f"(year({ts}) * 10000 + month({ts}) * 100 + day({ts}))"


DIMS = f"""
dim_location AS (
  SELECT row_number() OVER (ORDER BY borough NULLS LAST, zipcode) AS location_key, zipcode, borough
  FROM (SELECT zip AS zipcode, borough FROM a UNION SELECT zip, borough FROM b) WHERE zipcode IS NOT NULL),
dim_type AS (
  SELECT row_number() OVER (ORDER BY source, type_code) AS incident_type_key, type_code, source, category
  FROM (SELECT final_call_type AS type_code, 'EMS' AS source, 'Medical' AS category FROM a
        WHERE final_call_type IS NOT NULL GROUP BY 1
        UNION ALL
        SELECT class, 'FIRE', min(grp) FROM b WHERE class IS NOT NULL AND grp IS NOT NULL GROUP BY 1)),
dim_weather AS (
  SELECT row_number() OVER (ORDER BY h) AS weather_key, {date_key("h")} AS date_key, hour(h) AS hour,
         temp AS temp_f, precip AS precip_in, wind AS wind_mph, wind % 4 AS weather_code,
         CASE WHEN precip > 0 THEN 1 ELSE 0 END AS is_raining, CASE WHEN temp > 90 THEN 1 ELSE 0 END AS is_hot,
         CASE WHEN temp < 32 THEN 1 ELSE 0 END AS is_cold
  FROM hours)
"""

WIDE = """
dim_wide AS (
  SELECT row_number() OVER (ORDER BY borough NULLS LAST, zip NULLS LAST, precinct NULLS LAST, council NULLS LAST,
                            community NULLS LAST, school NULLS LAST, congress NULLS LAST) AS location_key, *
  FROM (SELECT borough, zip, precinct, council, community, school, congress FROM a
        UNION SELECT borough, zip, precinct, council, community, school, congress FROM b))
"""

GALAXY = ",".join([A, B, HOURLY, DIMS])


def times_key(ts) -> Column:
    return calendar_key(F.col(ts) if isinstance(ts, str) else ts)
