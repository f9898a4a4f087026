"""Mart tables as Parquet folders, small exports as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.storage import remove


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    table = spark.read.parquet(f"{folder}/{name}")
    return table.select(*columns) if columns else table


def write_table(df: DataFrame, folder: str, name: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{folder}/{name}")


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        write_table(df, folder, name)


def replace_partitions(df: DataFrame, folder: str, name: str, column: str, values: list[int]) -> None:
    """Replace the partitions `values` of a table by the rows of `df`; all other partitions stay as they are.

    A value without rows loses its partition. Files are of even size: a large partition is split over tasks, small ones meet.
    """
    kept = df.filter(F.col(column).isin(values)).hint("rebalance", F.col(column))
    path = f"{folder}/{name}"
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    spark = df.sparkSession
    filled = {r[0] for r in kept.select(column).distinct().collect()}
    for value in values:
        if value not in filled:
            remove(spark, f"{path}/{column}={value}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
