"""Data quality and profiling jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martloom.functions.times import parse_datetime
from martloom.plans.temporal import total
from martloom.storage import store


def key_health(dim: DataFrame, fact: DataFrame, key: str, foreign_key: str) -> DataFrame:
    """One row: null keys, repeated keys (nulls included) and null foreign keys."""
    of_dim = dim.groupBy(key).agg(F.count("*").alias("n"))
    keys = of_dim.agg(
        zero_sum(F.when(F.col(key).isNull(), F.col("n"))).alias("null_keys"),
        zero_sum(F.col("n") - 1).alias("duplicate_keys"),
    )
    nulls = fact.agg(F.count_if(F.col(foreign_key).isNull())).scalar()
    return keys.withColumn("null_foreign_keys", nulls)


def zero_sum(col):
    return F.coalesce(F.sum(col), F.lit(0)).cast("bigint")


def orphan_keys(fact: DataFrame, dim: DataFrame, foreign_key: str, key: str) -> DataFrame:
    """(key, rows) of foreign keys that the dimension lacks; the fact is folded to keys first."""
    used = fact.filter(F.col(foreign_key).isNotNull()).groupBy(F.col(foreign_key).alias("key")).agg(
        F.count("*").alias("rows")
    )
    known = dim.select(F.col(key).alias("key"))
    return used.join(known, "key", "left_anti")


def orphan_report(fact: DataFrame, dim: DataFrame, foreign_key: str, key: str, listed: int = 10) -> DataFrame:
    """Always one row: how many rows and keys are orphans, and the first `listed` of the keys."""
    orphans = store(orphan_keys(fact, dim, foreign_key, key), "orphans")
    first = orphans.orderBy("key").limit(listed).agg(F.array_sort(F.collect_list("key")).alias("first_keys"))
    totals = orphans.agg(zero_sum(F.col("rows")).alias("orphan_rows"), F.count("*").alias("orphan_keys"))
    return totals.withColumn("first_keys", first.scalar())


def key_consistency(dim: DataFrame, key: str = "date_key", year: str = "year") -> DataFrame:
    """One row: null years, and keys whose leading digits are not the year."""
    of_key = F.floor(F.col(key) / 10000)
    return dim.agg(
        F.count_if(F.col(year).isNull()).alias("null_years"),
        F.count_if(F.coalesce(of_key != F.col(year), F.lit(True))).alias("mismatched_years"),
    )


def years_in(fact: DataFrame, foreign_key: str, first: int | None = None) -> DataFrame:
    """The distinct years found in a date key, or the `first` of them."""
    years = fact.select(F.floor(F.col(foreign_key) / 10000).cast("int").alias("year")).dropna().distinct()
    return years if first is None else years.orderBy("year").limit(first)


def calendar_counts(fact: DataFrame, dim: DataFrame, foreign_key: str, year: int) -> DataFrame:
    """(month, day, n) for one year: rows are counted per key, the calendar is joined after."""
    used = fact.filter(F.col(foreign_key).isNotNull()).groupBy(F.col(foreign_key).alias("key")).agg(
        F.count("*").alias("n")
    )
    days = dim.filter(F.col("year") == year).select(F.col("date_key").alias("key"), "month", "day")
    return used.join(days, "key").groupBy("month", "day").agg(F.sum("n").alias("n"))


def calendar_heatmap(fact: DataFrame, dim: DataFrame, foreign_key: str, year: int) -> DataFrame:
    """One row per month, a column per day of month, empty cells 0."""
    counts = calendar_counts(fact, dim, foreign_key, year)
    return counts.groupBy("month").pivot("day", list(range(1, 32))).agg(total("n")).fillna(0)


def table_overview(df: DataFrame) -> DataFrame:
    """One row: the shape of a table and its column names."""
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_cols"),
        F.lit(", ".join(df.columns)).alias("columns"),
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def time_coverage(df: DataFrame, column: str = "INCIDENT_DATETIME", parsed: bool = False) -> DataFrame:
    """One row: first and last timestamp and the seconds between."""
    at = F.col(column) if parsed else parse_datetime(F.col(column))
    span = df.agg(F.min(at).alias("start"), F.max(at).alias("end"))
    return span.withColumn("duration_seconds", F.timestamp_diff("SECOND", "start", "end"))


def schema_diff_table(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per column name of either table: where it is and with which type."""
    spark = left.sparkSession
    layout = "column STRING, type STRING"
    ours = spark.createDataFrame(left.dtypes, layout).select("column", F.col("type").alias("left_type"))
    theirs = spark.createDataFrame(right.dtypes, layout).select("column", F.col("type").alias("right_type"))
    return (
        ours.join(theirs, "column", "full_outer")
        .select(
            "column",
            F.col("left_type").isNotNull().alias("in_left"),
            F.col("right_type").isNotNull().alias("in_right"),
            "left_type",
            "right_type",
        )
        .orderBy(F.desc("in_left"), F.desc("in_right"), F.asc("column"))
    )


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """(part, column, left_type, right_type), part being common, only_left or only_right."""
    part = (
        F.when(F.col("in_left") & F.col("in_right"), "common").when(F.col("in_left"), "only_left").otherwise("only_right")
    )
    mismatch = F.coalesce(F.col("left_type") != F.col("right_type"), F.lit(False))
    return schema_diff_table(left, right).select(
        part.alias("part"), "column", "left_type", "right_type", mismatch.alias("type_mismatch")
    )


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """`df` with a row count that fills in while the first action over it runs."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
