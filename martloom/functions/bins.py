"""Fixed-width bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_top(x: Column, width: int) -> Column:
    """Upper edge of the right-closed bin (lo, lo + width] that holds x, as BIGINT."""
    return F.ceil(x / F.lit(width)).cast("bigint") * width


def bin_edges(top: Column, width: int) -> list[Column]:
    return [
        (top - width).alias("bin_lo"),
        top.alias("bin_hi"),
        (top - F.lit(width / 2)).cast("double").alias("bin_mid"),
    ]


def bin_floor(x: Column, width: int) -> Column:
    """Lower edge of the left-closed bin [lo, lo + width) that holds x, as BIGINT."""
    return F.floor(x / F.lit(width)).cast("bigint") * width
