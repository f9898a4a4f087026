"""Data quality and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.plans import quality
from martloom.plans.dimensions import dim_time
from workload import roles
from workload.registry import query, table
from workload.roles import A, date_key


def order_days(spark, sf):
    """A calendar that misses July and, per order, repeats its days and loses some keys."""
    at = F.when(F.month("o_orderdate") != 7, F.col("o_orderdate"))
    return table(spark, sf, "orders").select(roles.times_key(at).alias("date_key"), F.year("o_orderdate").alias("year"))


def calendar(spark, sf):
    orders = table(spark, sf, "orders").filter(F.month("o_orderdate") != 7).select(F.col("o_orderdate").alias("INCIDENT_DATETIME"))
    return dim_time([orders])


def whole_calendar(spark, sf):
    return dim_time([table(spark, sf, "orders").select(F.col("o_orderdate").alias("INCIDENT_DATETIME"))])


def line_days(spark, sf):
    kept = F.when(F.col("l_quantity") != 50, F.col("l_shipdate"))
    return table(spark, sf, "lineitem").select(roles.times_key(kept).alias("incident_date_key"))


LINE_DAYS = f"line_days AS (SELECT CASE WHEN l_quantity <> 50 THEN {date_key('l_shipdate')} END AS k FROM lineitem)"
DAYS = f"days AS (SELECT DISTINCT {date_key('o_orderdate')} AS k, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders WHERE month(o_orderdate) <> 7)"

ALL_DAYS = DAYS.replace("days AS", "all_days AS").replace(" WHERE month(o_orderdate) <> 7", "")


@query(
    "key_health",
    "null_keys:int duplicate_keys:int null_foreign_keys:int",
    f"""SELECT count(*) FILTER (WHERE k IS NULL) AS null_keys, count(*) - count(DISTINCT {{'k': k}}) AS duplicate_keys,
         (SELECT count(*) FROM line_days WHERE k IS NULL) AS null_foreign_keys
       FROM (SELECT CASE WHEN month(o_orderdate) <> 7 THEN {date_key('o_orderdate')} END AS k FROM orders)""",
    LINE_DAYS,
)
def key_health(spark, sf):
    return quality.key_health(order_days(spark, sf), line_days(spark, sf), "date_key", "incident_date_key")


@query(
    "orphan_keys",
    "key:int rows:int",
    "SELECT k AS key, count(*) AS rows FROM line_days WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM days) GROUP BY 1",
    f"{LINE_DAYS}, {DAYS}",
)
def orphan_keys(spark, sf):
    return quality.orphan_keys(line_days(spark, sf), calendar(spark, sf), "incident_date_key", "date_key")


@query(
    "orphan_report",
    "orphan_rows:int orphan_keys:int first_keys:text",
    """SELECT count(*) AS orphan_rows, count(DISTINCT k) AS orphan_keys,
         coalesce((SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT DISTINCT k FROM o ORDER BY k LIMIT 10)), '') AS first_keys FROM o""",
    f"{LINE_DAYS}, {DAYS}, o AS (SELECT k FROM line_days WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM days))",
)
def orphan_report(spark, sf):
    report = quality.orphan_report(line_days(spark, sf), calendar(spark, sf), "incident_date_key", "date_key")
    return report.withColumn("first_keys", F.array_join("first_keys", ","))


@query(
    "key_consistency",
    "null_years:int mismatched_years:int",
    f"""SELECT count(*) FILTER (WHERE y IS NULL) AS null_years, count(*) FILTER (WHERE y IS NULL OR k // 10000 <> y) AS mismatched_years
       FROM (SELECT {date_key('o_orderdate')} AS k, CASE WHEN o_custkey % 10 = 0 THEN NULL WHEN o_custkey % 10 = 1 THEN 1999
               ELSE year(o_orderdate) END AS y FROM orders)""",
)
def key_consistency(spark, sf):
    orders = table(spark, sf, "orders")
    year = F.when(F.col("o_custkey") % 10 == 1, 1999).when(F.col("o_custkey") % 10 != 0, F.year("o_orderdate"))
    return quality.key_consistency(orders.select(roles.times_key("o_orderdate").alias("date_key"), year.alias("year")))


@query(
    "years_in",
    "year:int",
    "SELECT DISTINCT k // 10000 AS year FROM line_days WHERE k IS NOT NULL",
    LINE_DAYS,
)
def years_in(spark, sf):
    return quality.years_in(line_days(spark, sf), "incident_date_key")


@query(
    "calendar_counts",
    "month:int day:int n:int",
    "SELECT month, day, count(*) AS n FROM line_days JOIN all_days USING (k) WHERE year = 1996 GROUP BY 1, 2",
    f"{LINE_DAYS}, {ALL_DAYS}",
)
def calendar_counts(spark, sf):
    return quality.calendar_counts(line_days(spark, sf), whole_calendar(spark, sf), "incident_date_key", 1996)


HEAT_DAYS = list(range(1, 32))


@query(
    "calendar_heatmap",
    "month:int " + " ".join(f"d{d}:int" for d in HEAT_DAYS),
    "SELECT month, " + ", ".join(f"count(*) FILTER (WHERE day = {d}) AS d{d}" for d in HEAT_DAYS)
    + " FROM line_days JOIN all_days USING (k) WHERE year = 1996 GROUP BY 1",
    f"{LINE_DAYS}, {ALL_DAYS}",
)
def calendar_heatmap(spark, sf):
    wide = quality.calendar_heatmap(line_days(spark, sf), whole_calendar(spark, sf), "incident_date_key", 1996)
    return wide.withColumnsRenamed({str(d): f"d{d}" for d in HEAT_DAYS})


@query(
    "table_overview",
    "n_rows:int n_cols:int columns:text",
    """SELECT count(*) AS n_rows, 6 AS n_cols,
         'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority' AS columns FROM orders""",
)
def table_overview(spark, sf):
    return quality.table_overview(table(spark, sf, "orders"))


@query(
    "time_coverage",
    "first_at:time last_at:time duration_seconds:int",
    "SELECT min(dt) AS first_at, max(dt) AS last_at, date_diff('second', min(dt), max(dt)) AS duration_seconds FROM a",
    A,
)
def time_coverage(spark, sf):
    return quality.time_coverage(roles.raw_a(spark, sf)).withColumnsRenamed({"start": "first_at", "end": "last_at"})
