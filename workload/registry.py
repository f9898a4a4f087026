"""Registration of queries with their result columns and SQL.

A result is described as "name:type" words. Both sides are cast to that description, so a Spark
INT and a SQL HUGEINT meet as BIGINT, and timestamps meet as text. Types: int, float, float6
(rounded to six places), text, day, time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _spark_cast(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    return {
        "int": lambda: c.cast("bigint"),
        "float": lambda: c.cast("double"),
        "float6": lambda: F.round(c.cast("double"), 6) + F.lit(0.0),
        "text": lambda: c.cast("string"),
        "day": lambda: F.date_format(c, "yyyy-MM-dd"),
        "time": lambda: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
    }[kind]().alias(name)


def _sql_cast(name: str, kind: str) -> str:
    return {
        "int": f"CAST({name} AS BIGINT)",
        "float": f"CAST({name} AS DOUBLE)",
        "float6": f"round(CAST({name} AS DOUBLE), 6) + 0.0",
        "text": f"CAST({name} AS VARCHAR)",
        "day": f"strftime({name}, '%Y-%m-%d')",
        "time": f"strftime({name}, '%Y-%m-%d %H:%M:%S')",
    }[kind] + f" AS {name}"


def query(name: str, result: str, sql: str | None = None, ctes: str = "") -> Callable[[Query], Query]:
    columns = [tuple(word.split(":")) for word in result.split()]

    def register(job: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return job(spark, sf_dir).select(*[_spark_cast(n, k) for n, k in columns])

        run.__name__ = name
        run.__doc__ = job.__doc__
        QUERIES[name] = run
        if sql is not None:
            select = ", ".join(_sql_cast(n, k) for n, k in columns)
            prefix = f"WITH {ctes} " if ctes else ""
            ORACLES[name] = f"{prefix}SELECT {select} FROM ({sql}) AS result"
        return job

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
