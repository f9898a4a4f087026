"""Incremental staging: the batch projection over files as they arrive.

Conforming works row by row, so the same function serves a stream without state or watermark.
Dimensions and facts are then rebuilt from the staged table, as in a batch refresh.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from martloom.plans.staging import stage


def read_raw_stream(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """Raw CSV files of a folder, `columns` in file order, all as text."""
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    return spark.readStream.schema(schema).option("header", True).option("escape", '"').csv(folder)


def stage_new_files(raw: DataFrame, borough_column: str, out_folder: str, checkpoint: str) -> StreamingQuery:
    """Append what arrived since the last run to a staged Parquet table, then stop."""
    return (
        stage(raw, borough_column)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", out_folder)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
