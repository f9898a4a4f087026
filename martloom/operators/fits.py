"""Least-squares fits as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.storage import store


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: slope, intercept and r2 of y on x."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def quadratic_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: c0 + c1 x + c2 x^2 fitted to y, NULL when x has fewer than three values.

    Rows are first folded to one per x and stored, so the detail is read once. The folded rows give
    the mean of x and then the power sums around it; centring keeps the equations well conditioned.
    """
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    folded = store(points.groupBy("x").agg(F.count("*").alias("w"), F.sum("y").alias("t")), "folded")
    centre = folded.agg((F.sum(F.col("x") * F.col("w")) / F.sum("w")).alias("m"))
    u = F.col("x") - centre.scalar()
    w, t = F.col("w"), F.col("t")
    sums = folded.agg(
        F.sum("w").alias("n"),
        F.sum(w * u * u).alias("s2"),
        F.sum(w * u * u * u).alias("s3"),
        F.sum(w * u * u * u * u).alias("s4"),
        F.sum("t").alias("t0"),
        F.sum(t * u).alias("t1"),
        F.sum(t * u * u).alias("t2"),
        F.sum(F.col("x") * w).alias("sx"),
        F.count("*").alias("values"),
    )
    n, s2, s3, s4 = (F.col(c) for c in ("n", "s2", "s3", "s4"))
    t0, t1, t2 = (F.col(c) for c in ("t0", "t1", "t2"))
    curve = F.when(
        F.col("values") >= 3,
        F.try_divide(t2 - F.try_divide(s3, s2) * t1 - F.try_divide(s2, n) * t0, s4 - F.try_divide(s3 * s3, s2) - F.try_divide(s2 * s2, n)),
    )
    solved = sums.withColumn("m", F.try_divide(F.col("sx"), n)).withColumn("c", curve)
    solved = solved.withColumn("b", F.try_divide(t1 - s3 * F.col("c"), s2))
    solved = solved.withColumn("a", F.try_divide(t0 - s2 * F.col("c"), n))
    a, b, c, m = (F.col(k) for k in ("a", "b", "c", "m"))
    return solved.select(
        (a - b * m + c * m * m).alias("c0"), (b - 2 * c * m).alias("c1"), c.alias("c2"), F.col("n").alias("n")
    )
