"""Principal components of a few columns of a big table.

The data is read once by an aggregation that brings back one number per pair of columns. The
small matrix is solved on the driver; scores are a projection computed where the rows are. For many columns each
task multiplies tiles of the matrix, and Spark adds up the tiles of all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.storage import store

# Labels for extremes, table rows, and the share two axes should reach.
EXTREMES = 10
WORST = 20
ENOUGH_SHARE = 0.60

# Columns from which on products are taken in tiles, the columns of a tile, and rows looked at for a centre.
MANY_COLUMNS = 24
TILE = 64
CENTRE_ROWS = 1000


@dataclass(frozen=True)
class Components:
    """What a fit leaves behind; `vectors[i][k]` is the weight of feature i in component k."""

    spark: SparkSession
    features: list[str]
    rows: int
    means: list[float]
    scales: list[float]
    correlation: list[list[float]]
    values: list[float]
    ratios: list[float]
    vectors: list[list[float]]

    def eigen(self) -> DataFrame:
        """Per component its variance, share and running share."""
        running = np.cumsum(self.ratios)
        rows = [(k + 1, v, r, float(c)) for k, (v, r, c) in enumerate(zip(self.values, self.ratios, running))]
        return self.spark.createDataFrame(rows, "pc INT, eigenvalue DOUBLE, ratio DOUBLE, cumulative DOUBLE")

    def scree(self) -> DataFrame:
        return self.eigen().select(
            "pc", (F.col("ratio") * 100).alias("percent"), (F.col("cumulative") * 100).alias("cumulative_percent")
        )

    def loading(self, feature: int, pc: int) -> float:
        return self.vectors[feature][pc] * float(np.sqrt(max(self.values[pc], 0.0)))

    def loadings(self) -> DataFrame:
        rows = [(f, k + 1, self.loading(i, k)) for i, f in enumerate(self.features) for k in range(len(self.values))]
        return self.spark.createDataFrame(rows, "feature STRING, pc INT, loading DOUBLE")

    def circle(self, pc_x: int = 1, pc_y: int = 2) -> DataFrame:
        """Loadings on a plane, the arrows of a correlation circle."""
        rows = [(f, self.loading(i, pc_x - 1), self.loading(i, pc_y - 1)) for i, f in enumerate(self.features)]
        return self.spark.createDataFrame(rows, "feature STRING, x DOUBLE, y DOUBLE")

    def planes(self) -> DataFrame:
        """The planes worth drawing: PC1-PC2, also PC1-PC3 when the first two say too little."""
        planes = [(1, 2)]
        if len(self.ratios) > 2 and sum(self.ratios[:2]) < ENOUGH_SHARE:
            planes.append((1, 3))
        return self.spark.createDataFrame(planes, "pc_x INT, pc_y INT")

    def z(self, i: int) -> Column:
        mean = F.lit(self.means[i])
        value = F.coalesce(F.col(f"`{self.features[i]}`").cast("double"), mean)
        return (value - mean) / F.lit(self.scales[i])

    def standardised(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return df.select(*keep, *[self.z(i).alias(f) for i, f in enumerate(self.features)])

    def scores(self, df: DataFrame, keep: list[str], axes: list[int] | None = None) -> DataFrame:
        """`keep` plus one score column pcN per component."""
        axes = axes or list(range(1, len(self.values) + 1))
        with_z = df.select(*keep, *[self.z(i).alias(f"__z{i}") for i in range(len(self.features))])
        return with_z.select(*keep, *[self._score(k).alias(f"pc{k}") for k in axes])

    def _score(self, pc: int) -> Column:
        terms = [F.col(f"__z{i}") * F.lit(self.vectors[i][pc - 1]) for i in range(len(self.features))]
        return sum(terms[1:], terms[0])

    def extremes(self, df: DataFrame, id_column: str, pc_x: int = 1, pc_y: int = 2, k: int = EXTREMES) -> DataFrame:
        """The k points furthest from the origin of a plane."""
        return self.distances(df, id_column, pc_x, pc_y).orderBy(F.desc("dist"), F.asc(id_column)).limit(k)

    def distances(self, df: DataFrame, id_column: str, pc_x: int = 1, pc_y: int = 2) -> DataFrame:
        """Every point of a plane with its distance from the origin."""
        plane = self.scores(df, [id_column], [pc_x, pc_y])
        return plane.withColumn("dist", F.sqrt(F.pow(f"pc{pc_x}", F.lit(2)) + F.pow(f"pc{pc_y}", F.lit(2))))

    def quality(self, df: DataFrame, id_column: str, pc_x: int = 1, pc_y: int = 2) -> DataFrame:
        """Squared cosine per row: how much of it a plane shows."""
        d = len(self.features)
        with_z = df.select(id_column, *[self.z(i).alias(f"__z{i}") for i in range(d)])
        length = sum((F.col(f"__z{i}") * F.col(f"__z{i}") for i in range(1, d)), F.col("__z0") * F.col("__z0"))
        shares = with_z.select(
            id_column,
            F.try_divide(F.pow(self._score(pc_x), F.lit(2)), length).alias("cos2_x"),
            F.try_divide(F.pow(self._score(pc_y), F.lit(2)), length).alias("cos2_y"),
        )
        return shares.select(
            id_column,
            F.round("cos2_x", 3).alias("cos2_x"),
            F.round("cos2_y", 3).alias("cos2_y"),
            F.round(F.col("cos2_x") + F.col("cos2_y"), 3).alias("quality"),
        )

    def worst(self, df: DataFrame, id_column: str, pc_x: int = 1, pc_y: int = 2, k: int = WORST) -> DataFrame:
        """The rows a plane represents worst."""
        return self.quality(df, id_column, pc_x, pc_y).orderBy(F.asc_nulls_last("quality"), F.asc(id_column)).limit(k)


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    skip = set(exclude or [])
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def fit_usable(
    df: DataFrame, features: list[str] | None = None, missing: str = "drop", components: int | None = None
) -> tuple[DataFrame, Components]:
    """(rows, fit): the rows that `missing` leaves, stored, and the fit on exactly those.

    Scores, extremes and quality of a `drop` fit belong to these rows; on others they would fill means.
    """
    rows = store(usable_rows(df, missing), "usable_rows") if missing == "drop" else usable_rows(df, missing)
    return rows, fit_components(rows, features, "impute", components)


def usable_rows(df: DataFrame, missing: str) -> DataFrame:
    """`impute` keeps all rows and fills means later; `drop` keeps complete, distinct rows."""
    if missing == "impute":
        return df
    if missing == "drop":
        return df.dropna().dropDuplicates()
    raise ValueError(f"missing must be 'impute' or 'drop', not {missing!r}")


def fit_components(
    df: DataFrame, features: list[str] | None = None, missing: str = "impute", components: int | None = None
) -> Components:
    """Fit on standardised columns: z scores over N, variances over N - 1."""
    features = features or numeric_columns(df)
    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}")
    data = usable_rows(df, missing).select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    d = len(features)
    n, means, covariance = _moments_in_tiles(data, d) if d >= MANY_COLUMNS else _moments(data, d)
    if n < 2:
        raise ValueError("components need at least two rows")
    spread = np.sqrt(np.diag(covariance))
    scales = np.where(spread > 0, spread, 1.0)
    correlation = covariance / np.outer(scales, scales)
    values, vectors = np.linalg.eigh(correlation)
    order = np.argsort(-values, kind="stable")[: components or d]
    total = float(np.sum(values)) or 1.0
    kept_vectors = np.column_stack([_facing(vectors[:, k]) for k in order])
    return Components(
        spark=df.sparkSession,
        features=list(features),
        rows=n,
        means=[float(m) for m in means],
        scales=[float(s) for s in scales],
        correlation=correlation.tolist(),
        values=[float(values[k]) * n / (n - 1) for k in order],
        ratios=[float(values[k]) / total for k in order],
        vectors=kept_vectors.tolist(),
    )


def _moments(data: DataFrame, d: int) -> tuple[int, list[float], np.ndarray]:
    """Rows, means and covariance of the columns x0 to x(d-1), from one aggregate per pair."""
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    measures = [F.count("*").alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(d)]]
    for i, j in pairs:
        y, x = f"x{i}", f"x{j}"
        measures += [
            F.regr_count(y, x).alias(f"n_{i}_{j}"),
            F.covar_pop(y, x).alias(f"c_{i}_{j}"),
            F.regr_avgy(y, x).alias(f"y_{i}_{j}"),
            F.regr_avgx(y, x).alias(f"x_{i}_{j}"),
        ]
    got = data.agg(*measures).first()
    n = got["n"]
    means = [got[f"m{i}"] if got[f"m{i}"] is not None else 0.0 for i in range(d)]
    covariance = np.zeros((d, d))
    for i, j in pairs:
        # pairs are counted where both values exist; a mean-filled value deviates by zero
        both = got[f"n_{i}_{j}"]
        if both:
            about = (got[f"y_{i}_{j}"] - means[i]) * (got[f"x_{i}_{j}"] - means[j])
            covariance[i, j] = covariance[j, i] = both * (got[f"c_{i}_{j}"] + about) / n
    return n, means, covariance


_PRODUCTS = "i INT, j INT, n BIGINT, xy DOUBLE, x DOUBLE, y DOUBLE"


def tile_products(x: np.ndarray, sums: dict[tuple[int, int], np.ndarray]) -> None:
    """Add to each tile what the rows of `x` give: for columns i and j over the rows that have both, how many there
    are and the sums of x_i x_j, x_i and x_j."""
    there = ~np.isnan(x)
    value, count = np.where(there, x, 0.0), there.astype(np.float64)
    for a in range(0, x.shape[1], TILE):
        for b in range(a, x.shape[1], TILE):
            left, right = slice(a, a + TILE), slice(b, b + TILE)
            more = np.stack(
                [
                    count[:, left].T @ count[:, right],
                    value[:, left].T @ value[:, right],
                    value[:, left].T @ count[:, right],
                    count[:, left].T @ value[:, right],
                ]
            )
            sums[a, b] = sums[a, b] + more if (a, b) in sums else more


def _moments_in_tiles(data: DataFrame, d: int) -> tuple[int, list[float], np.ndarray]:
    """As `_moments`, for many columns: one scan, in which every task multiplies its rows tile by tile.

    A task sends each pair of columns once, whatever its rows. Values are taken from a rough centre, the means of
    a few rows, which changes rounding only. The centre and the sums that come back are as large as the matrix to be solved.
    """
    rough = data.limit(CENTRE_ROWS).agg(*[F.avg(f"x{i}") for i in range(d)]).first()
    finite = lambda v: v if v is not None and np.isfinite(v) else 0.0
    centre = np.array([finite(v) for v in rough])

    def multiply(batches) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            columns = [np.asarray(c.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64) for c in batch.columns]
            # a null arrives as NaN; a NaN of the data counts as missing too
            tile_products(np.stack(columns, 1) - centre, sums)
        for (a, b), tile in sums.items():
            i, j = (v.reshape(-1) for v in np.mgrid[a : a + tile.shape[1], b : b + tile.shape[2]])
            flat = tile.reshape(4, -1)[:, i <= j]
            i, j = i[i <= j], j[i <= j]
            arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(flat[0].astype(np.int64)), *[pa.array(f) for f in flat[1:]]]
            yield pa.record_batch(arrays, ["i", "j", "n", "xy", "x", "y"])

    products = data.select(*[f"x{i}" for i in range(d)]).mapInArrow(multiply, _PRODUCTS)
    each = products.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "xy", "x", "y")]).collect()
    rows = data.count()
    about = np.zeros(d)
    for r in each:
        if r["i"] == r["j"] and r["n"]:
            about[r["i"]] = r["x"] / r["n"]
    covariance = np.zeros((d, d))
    for r in each:
        i, j = r["i"], r["j"]
        moved = r["xy"] - about[i] * r["y"] - about[j] * r["x"] + about[i] * about[j] * r["n"]
        covariance[i, j] = covariance[j, i] = moved / rows
    noise = (np.abs(centre + about) * 1e-13) ** 2  # of a column whose values are all the same
    same = np.diag(covariance) <= noise
    covariance[same, :] = covariance[:, same] = 0.0
    return rows, (centre + about).tolist(), covariance


def _facing(vector: np.ndarray) -> np.ndarray:
    """Turn a component so that its strongest weight, the first on a tie, is positive."""
    size = np.abs(vector)
    lead = int(np.argmax(size >= size.max() - 1e-9))
    return vector if vector[lead] >= 0 else -vector


def correlation_table(fit: Components) -> DataFrame:
    rows = [
        (a, b, fit.correlation[i][j])
        for i, a in enumerate(fit.features)
        for j, b in enumerate(fit.features)
        if i <= j
    ]
    return fit.spark.createDataFrame(rows, "feature_a STRING, feature_b STRING, corr DOUBLE")
