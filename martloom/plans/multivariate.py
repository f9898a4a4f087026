"""Feature matrices and component runs over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.components import Components, fit_components

# The features of the two runs.
FIRE_FEATURES = ["Dispatch_Time_Sec", "Travel_Time_Sec", "Engines", "Ladders", "Other_Units"]
AREA_FEATURES = [
    "EMS_Incident_Count",
    "EMS_Avg_Response_Time",
    "Fire_Incident_Count",
    "Fire_Avg_Response_Time",
]
UNKNOWN_GROUP = "Unknown"


def fire_matrix(fact_fire: DataFrame) -> DataFrame:
    """One row per fire incident with the efficiency features."""
    return fact_fire.select(
        "incident_id",
        F.col("dispatch_time").alias("Dispatch_Time_Sec"),
        F.col("travel_time").alias("Travel_Time_Sec"),
        F.col("engines_assigned_quantity").alias("Engines"),
        F.col("ladders_assigned_quantity").alias("Ladders"),
        F.col("other_units_assigned_quantity").alias("Other_Units"),
    )


def folded_responses(fact: DataFrame, key: str) -> DataFrame:
    """(key, n, timed, total): rows, rows with a response time and their sum; join the zip to this, not to the fact."""
    return fact.groupBy(key).agg(
        F.count("*").alias("n"), F.count("response_time").alias("timed"), F.sum("response_time").alias("total")
    )


def area_matrix(ems: DataFrame, fire: DataFrame) -> DataFrame:
    """Per zip the count and mean response time of both sources, zips of either side kept.

    Inputs have (zipcode, response_time), or what `folded_responses` makes of facts. Both are folded to
    zips before they meet.
    """

    def per_zip(fact: DataFrame, prefix: str) -> DataFrame:
        folded = fact if "n" in fact.columns else folded_responses(fact, "zipcode")
        return (
            folded.filter(F.col("zipcode").isNotNull())
            .groupBy(F.col("zipcode").alias("ZIPCODE"))
            .agg(
                F.sum("n").alias(f"{prefix}_Incident_Count"),
                F.try_divide(F.sum("total"), F.sum("timed")).alias(f"{prefix}_Avg_Response_Time"),
            )
        )

    joined = per_zip(ems, "EMS").join(per_zip(fire, "Fire"), "ZIPCODE", "full_outer")
    return joined.fillna(0, ["EMS_Incident_Count", "Fire_Incident_Count"])


def fire_components(fact_fire: DataFrame) -> tuple[DataFrame, Components]:
    matrix = fire_matrix(fact_fire)
    return matrix, fit_components(matrix, FIRE_FEATURES)


def area_components(ems: DataFrame, fire: DataFrame, missing: str = "impute") -> tuple[DataFrame, Components]:
    matrix = area_matrix(ems, fire)
    return matrix, fit_components(matrix, AREA_FEATURES, missing)


def grouped_scores(scores: DataFrame, mapping: DataFrame, id_column: str, group: str) -> DataFrame:
    """Scores with the group of their id, 'Unknown' where the mapping has none."""
    known = mapping.select(F.col(id_column).alias("__id"), F.col(group).alias("__group"))
    return (
        scores.join(known, F.col(id_column) == F.col("__id"), "left")
        .withColumn(group, F.coalesce("__group", F.lit(UNKNOWN_GROUP)))
        .drop("__id", "__group")
    )
