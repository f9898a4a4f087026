import os
import random

import pytest
from pyspark.sql import functions as F

from martloom.operators.keys import HEAVY_KEYS, attach_key, dense_key, heavy_keys
from martloom.storage import fits_broadcast, kept_until_done, store


@pytest.fixture
def many_ranges(spark):
    """Keep tiny ranges apart, as a big table would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def keyed(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string")
    return [(r["k"], r["a"], r["b"]) for r in dense_key(df, "k", ["b", "a"]).orderBy("k").collect()]


def test_dense_key_is_sorted_nulls_last_and_without_gaps(spark, many_ranges):
    rows = [(i, b) for i in [*range(300), None] for b in ["x", "Y", None]]
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or "", r[0] is None, r[0] or 0))
    assert keyed(spark, shuffled) == [(i + 1, *r) for i, r in enumerate(want)]


def test_dense_key_ranges_are_really_split(spark, many_ranges):
    df = spark.range(5000).select(F.col("id").cast("int").alias("a"))
    out = dense_key(df, "k", ["a"])
    assert out.select(F.spark_partition_id()).distinct().count() > 1
    assert out.filter("k <> a + 1").count() == 0


def test_dense_key_of_nothing(spark):
    assert keyed(spark, []) == []


def hot_fact(spark):
    """A third of the rows share one key, a third have no key."""
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, (F.col("id") % 50).cast("int")).alias("zip"),
        F.when(F.col("id") % 4 == 0, "B").alias("borough"),
    )


def small_dim(spark):
    pairs = [(z, b) for z in [*range(40), None] for b in ["B", None]]
    return spark.createDataFrame([(i, z, b) for i, (z, b) in enumerate(pairs)], "key int, zip int, borough string")


@pytest.mark.parametrize("null_safe", [True, False])
def test_broadcast_and_salted_attachment_agree(spark, null_safe):
    fact, dim = hot_fact(spark), small_dim(spark)
    on = [("zip", "zip"), ("borough", "borough")]
    broadcast = attach_key(fact, dim, on, "key", null_safe)
    salted = attach_key(fact, dim, on, "key", null_safe, broadcast_rows=0)
    assert "BroadcastHashJoin" in broadcast._jdf.queryExecution().executedPlan().toString()
    assert salted.columns == broadcast.columns == ["id", "zip", "borough", "key"]
    got = sorted(broadcast.collect())
    assert got == sorted(salted.collect())
    lookup = {(r["zip"], r["borough"]): r["key"] for r in dim.collect()}
    for r in got:
        complete = r["zip"] is not None and r["borough"] is not None
        assert r["key"] == (lookup.get((r["zip"], r["borough"])) if null_safe or complete else None)


def test_only_heavy_keys_are_copied(spark):
    fact = hot_fact(spark)
    heavy = {r["heavy"]: r["copies"] for r in heavy_keys(fact, F.xxhash64(F.col("zip").cast("bigint"))).collect()}
    hashes = {r["h"]: r["zip"] for r in fact.select("zip", F.xxhash64(F.col("zip").cast("bigint")).alias("h")).distinct().collect()}
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = {r["zip"]: r["count"] for r in fact.groupBy("zip").count().collect()}
    assert {hashes[h] for h in heavy} == {z for z, n in counts.items() if n * HEAVY_KEYS > 3000}
    assert sum(heavy.values()) <= partitions + 2 * len(heavy)
    rare = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("zip"))
    assert heavy_keys(rare, F.xxhash64("zip")).count() == 1
    assert heavy_keys(rare.limit(0), F.xxhash64("zip")).count() == 0


def test_heavy_rows_are_spread(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("zip"))
    dim = spark.range(20_000).select(F.col("id").alias("zip"), (F.col("id") * 2).alias("key"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = attach_key(rows, dim, [("zip", "zip")], "key", broadcast_rows=0)
        assert out.filter("key is null or key <> zip * 2").count() == 0 and out.count() == 20_000
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 20_000 / 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kind", ["double", "string", "bigint", "decimal(9,2)"])
def test_keys_of_differing_types_still_meet(spark, kind):
    fact = hot_fact(spark)
    dim = spark.range(40).select(F.col("id").cast(kind).alias("zip"), F.col("id").alias("key"))
    big = attach_key(fact, dim, [("zip", "zip")], "key", broadcast_rows=0)
    assert sorted(big.collect()) == sorted(attach_key(fact, dim, [("zip", "zip")], "key").collect())
    assert big.filter("key is not null").count() == fact.filter("zip < 40").count()


def test_salted_side_is_not_broadcast_when_too_big(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = attach_key(hot_fact(spark), small_dim(spark), [("zip", "zip")], "key", broadcast_rows=0)
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "__salt" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_tables_go_with_their_block(spark):
    outer = store(spark.range(3), "outer")
    with kept_until_done(spark):
        inner = store(spark.range(4), "inner")
        (name,) = {f.rsplit("/", 2)[0].removeprefix("file://") for f in inner.inputFiles()}
        assert inner.count() == 4 and os.path.isdir(name)
    assert not os.path.exists(name) and outer.count() == 3


def test_storage(spark, tmp_path):
    kept = store(spark.range(10), "ids")
    assert kept.count() == 10 and len(kept.inputFiles()) >= 1
    assert fits_broadcast(kept, 10) and not fits_broadcast(kept, 9)
