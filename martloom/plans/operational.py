"""Operational marts: misclassification flows, load curves, resource use, delay anatomy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.bins import bin_edges, bin_top
from martloom.functions.numbers import zero_if_null
from martloom.operators.exact import group_means
from martloom.operators.fits import quadratic_fit
from martloom.plans.temporal import total
from martloom.storage import store

# Flows and consumers shown, load bins, the dispatch time that ends the analysis.
TOP_FLOWS = 20
TOP_CONSUMERS = 10
LOAD_WIDTH = 20
DISPATCH_BELOW = 600
FROM_LABEL = " (Dispatched As)"
TO_LABEL = " (Actually Was)"


def _ranked_flows(fact: DataFrame, k: int) -> DataFrame:
    counts = fact.groupBy("initial_call_type", "final_call_type").agg(F.count("*").alias("value"))
    return counts.orderBy(F.desc("value"), F.asc("initial_call_type"), F.asc("final_call_type")).limit(k)


def flow_links(fact: DataFrame, k: int = TOP_FLOWS) -> DataFrame:
    """The most frequent changes from initial to final type."""
    known = fact.dropna(subset=["initial_call_type", "final_call_type"])
    return _ranked_flows(known.filter(F.col("initial_call_type") != F.col("final_call_type")), k)


def flow_links_all(fact: DataFrame, k: int = TOP_FLOWS) -> DataFrame:
    """Variant: unchanged types count too."""
    return _ranked_flows(fact.dropna(subset=["initial_call_type", "final_call_type"]), k)


def flow_nodes(links: DataFrame, labelled: bool = True) -> DataFrame:
    """(node, label) numbered from 0 by first appearance: all sources by rank, then all targets.

    `links` has at most the k rows of a top list, so its windows are as small.
    """
    ranks = _ranks(links)
    ends = ranks.select(
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("side"), "rank", _from(labelled).alias("label")),
                F.struct(F.lit(1).alias("side"), "rank", _to(labelled).alias("label")),
            )
        )
    )
    first = ends.groupBy("label").agg(F.min(F.struct("side", "rank")).alias("first"))
    return first.select((F.row_number().over(Window.orderBy("first")) - 1).alias("node"), "label")


def flow_indices(links: DataFrame, labelled: bool = True) -> DataFrame:
    """(source, target, value): the links in terms of node numbers."""
    links = store(links, "links")
    nodes = flow_nodes(links, labelled)
    ends = links.select(_from(labelled).alias("from_label"), _to(labelled).alias("to_label"), "value")
    sources = nodes.select(F.col("node").alias("source"), F.col("label").alias("from_label"))
    targets = nodes.select(F.col("node").alias("target"), F.col("label").alias("to_label"))
    return ends.join(sources, "from_label").join(targets, "to_label").select("source", "target", "value")


def _ranks(links: DataFrame) -> DataFrame:
    order = Window.orderBy(F.desc("value"), F.asc("initial_call_type"), F.asc("final_call_type"))
    return links.withColumn("rank", F.row_number().over(order))


def _from(labelled: bool):
    return F.concat("initial_call_type", F.lit(FROM_LABEL if labelled else ""))


def _to(labelled: bool):
    return F.concat("final_call_type", F.lit(TO_LABEL if labelled else ""))


def hourly_load(fact: DataFrame, exact: bool = False) -> DataFrame:
    """Per hour on the calendar the units deployed and the mean dispatch time."""
    placed = fact.filter(F.col("date_key").isNotNull() & F.col("hour").isNotNull())
    folded = group_means(placed, ["date_key", "hour"], {"dispatch_time": "dispatch_time"}, {"n": "total_units"}, exact)
    return folded.select("date_key", "hour", zero_if_null(F.col("n")).alias("total_units"), "dispatch_time")


def stress_test(fact: DataFrame, width: int = LOAD_WIDTH, exact: bool = False) -> DataFrame:
    """Mean of the hourly mean dispatch times per load bin, only bins that occur."""
    hours = hourly_load(fact, exact).filter((F.col("dispatch_time") < DISPATCH_BELOW) & (F.col("total_units") > 0))
    hours = hours.withColumn("top", bin_top(F.col("total_units"), width))
    binned = group_means(hours, ["top"], {"dispatch_time": "dispatch_time"}, exact=exact)
    return binned.select(*bin_edges(F.col("top"), width), "dispatch_time")


def saturation_fit(fact: DataFrame) -> DataFrame:
    """Variant: quadratic of dispatch time on units, incident by incident."""
    return quadratic_fit(fact.filter(F.col("dispatch_time") < DISPATCH_BELOW), "total_units", "dispatch_time")


def resource_use(fact: DataFrame, types: DataFrame) -> DataFrame:
    """Unit-seconds and unit-hours per category; folded to type keys before the names are joined."""
    active = zero_if_null(F.col("dispatch_time")) + zero_if_null(F.col("travel_time"))
    folded = fact.groupBy("incident_type_key").agg(F.sum(F.col("total_units") * active).alias("cost"))
    named = folded.join(types.select("incident_type_key", "category"), "incident_type_key")
    return (
        named.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(total("cost").alias("resource_cost_seconds"))
        .withColumn("resource_hours", F.col("resource_cost_seconds") / 3600)
    )


def resource_consumption(fact: DataFrame, types: DataFrame, k: int = TOP_CONSUMERS) -> DataFrame:
    """The categories that use most unit-hours."""
    return resource_use(fact, types).orderBy(F.desc("resource_hours"), F.asc("category")).limit(k)


def delay_anatomy(fact: DataFrame, exact: bool = False) -> DataFrame:
    """Per hour the mean dispatch and travel times as percentages of their sum."""
    timed = fact.filter(F.col("hour").isNotNull())
    means = group_means(timed, ["hour"], {"dispatch": "dispatch_time", "travel": "travel_time"}, exact=exact)
    whole = F.col("dispatch") + F.col("travel")
    return means.select(
        "hour",
        (F.try_divide(F.col("dispatch"), whole) * 100).alias("dispatch_pct"),
        (F.try_divide(F.col("travel"), whole) * 100).alias("travel_pct"),
    )
