"""Geographic marts: area rollup, speed trap, triage matrix, station reach."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.geometry import centroid
from martloom.functions.numbers import zero_if_null
from martloom.operators.exact import group_means
from martloom.operators.nearest import distinct_positions, nearest_site
from martloom.storage import store

# Ring size of the busiest area, areas named in the triage matrix.
RING_SIZE = 800
TOP_AREAS = 5


def area_rollup(fact: DataFrame, location: DataFrame, exact: bool = False) -> DataFrame:
    """Per zip the volume and the unweighted mean of its locations' mean response times.

    The two levels are meant: each location counts once, however many incidents it has. The result
    is stored, since every other geographic mart reads it more than once. With `exact`, the means of
    both levels do not depend on the order of rows.
    """
    placed = fact.filter(F.col("location_key").isNotNull())
    per_location = group_means(placed, ["location_key"], {"response": "response_time"}, {"n": "nb_interventions"}, exact)
    per_location = per_location.withColumn("volume", zero_if_null(F.col("n")))
    named = per_location.join(location.select("location_key", "zipcode"), "location_key").filter(F.col("zipcode").isNotNull())
    per_zip = group_means(named, ["zipcode"], {"response_time": "response"}, {"nb_interventions": "volume"}, exact)
    return store(per_zip.select("zipcode", "nb_interventions", "response_time"), "area_rollup")


def area_points(areas: DataFrame) -> DataFrame:
    """(area_code, x, y): the centroid of each area."""
    return areas.withColumn("at", centroid(F.col("parts"))).select("area_code", "at.x", "at.y")


def speed_trap(rollup: DataFrame, areas: DataFrame) -> DataFrame:
    """Every area with its volume, response time and ring size; areas without data stay."""
    stats = rollup.select(F.col("zipcode").cast("string").alias("code"), "nb_interventions", "response_time")
    joined = areas.join(stats, F.col("area_code") == F.col("code"), "left").drop("code")
    busiest = joined.agg(F.max("nb_interventions")).scalar()
    return joined.withColumn("ring_size", F.try_divide(F.col("nb_interventions"), busiest) * RING_SIZE)


def _averages(rollup: DataFrame) -> tuple[Column, Column]:
    return (
        rollup.agg(F.avg("nb_interventions")).scalar(),
        rollup.agg(F.avg("response_time")).scalar(),
    )


def triage_matrix(rollup: DataFrame) -> DataFrame:
    """Each area against the averages of all areas, with the quadrant it falls into."""
    volume, response = _averages(rollup)
    marked = rollup.withColumns({"avg_volume": volume, "avg_response": response})
    busy, slow = F.col("nb_interventions") > F.col("avg_volume"), F.col("response_time") > F.col("avg_response")
    quadrant = (
        F.when(F.col("response_time").isNull(), F.lit(None))
        .when(busy & slow, "problem area")
        .when(busy, "efficient hub")
        .when(slow, "hard to reach")
        .otherwise("quiet enclave")
    )
    return marked.withColumns({"quadrant": quadrant, "is_critical": F.coalesce(busy & slow, F.lit(False)).cast("int")})


def triage_top(rollup: DataFrame, k: int = TOP_AREAS) -> DataFrame:
    """The critical areas with the largest volume x response."""
    critical = triage_matrix(rollup).filter(F.col("is_critical") == 1)
    scored = critical.withColumn("impact", F.col("nb_interventions") * F.col("response_time"))
    return scored.orderBy(F.desc("impact"), F.asc("zipcode")).limit(k).select(
        "zipcode", "nb_interventions", "response_time", "impact"
    )


def triage_top_dist(rollup: DataFrame, k: int = TOP_AREAS) -> DataFrame:
    """Variant: critical areas by the product of their distances from both averages."""
    critical = triage_matrix(rollup).filter(F.col("is_critical") == 1)
    dist = (F.col("nb_interventions") - F.col("avg_volume")) * (F.col("response_time") - F.col("avg_response"))
    return critical.withColumn("dist", dist).orderBy(F.desc("dist"), F.asc("zipcode")).limit(k).select(
        "zipcode", "nb_interventions", "response_time", "dist"
    )


def station_reach(
    points: DataFrame,
    response: DataFrame,
    sites: DataFrame,
    site_id: str = "firehouse_key",
    x: str = "Longitude",
    y: str = "Latitude",
) -> DataFrame:
    """Mean response time of the areas nearest to each site; a site without areas keeps a NULL.

    `points` is (area_code, x, y), `response` (area_code, response_time). Sites at one position
    share their territory.
    """
    response = store(response.select("area_code", "response_time"), "area_response")
    measured = points.join(response, "area_code")
    assigned = nearest_site(measured, sites, "area_code", "x", "y", site_id, x, y)
    per_territory = (
        assigned.join(response.withColumnRenamed("area_code", "point_id"), "point_id")
        .groupBy(F.col("site_id").alias("territory"))
        .agg(F.avg("response_time").alias("response_time"), F.count("*").alias("areas"))
    )
    positions = distinct_positions(sites, site_id, x, y).withColumnRenamed("site_id", "territory")
    placed = sites.dropna(subset=[x, y]).select(
        F.col(site_id).alias("site_id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    )
    shared = placed.join(positions, (F.col("x") == F.col("sx")) & (F.col("y") == F.col("sy"))).drop("sx", "sy")
    return shared.join(per_territory, "territory", "left").select(
        "site_id", "territory", "response_time", F.coalesce("areas", F.lit(0)).alias("areas")
    )
