"""Dense surrogate keys and their attachment to facts."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.storage import exists, fits_broadcast, store

_POSITION = "__position"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits

# A key is heavy when it holds more than one in this many rows of the fact, so no more keys are.
HEAVY_KEYS = 500
# Keys that the counting sketch keeps; it errs by less than one row in 2,000.
_TRACKED = 10_000
# Copies of a whole lookup whose keys have types that cannot be hashed alike on both sides.
SALTS = 16

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_PLAIN = (T.StringType(), T.DateType(), T.TimestampType(), T.BooleanType())


def dense_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Prefix distinct `rows` with a key 1..N in the order of `order`, nulls last.

    The rows are range partitioned and sorted where they are, so no task sees more than its own
    range. What comes to the driver is one count per range.
    """
    by = [F.col(f"`{c}`").asc_nulls_last() for c in order]
    ranged = (
        rows.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn(_POSITION, F.monotonically_increasing_id())
    )
    stored = store(ranged, key)
    run = F.shiftright(_POSITION, _ROW_BITS).cast("int")
    counts = {r["run"]: r["n"] for r in stored.groupBy(run.alias("run")).agg(F.count("*").alias("n")).collect()}
    sizes = [counts.get(i, 0) for i in range(max(counts, default=-1) + 1)]
    starts = [0, *accumulate(sizes)]
    offset = F.lit(0) if len(sizes) < 2 else F.get(F.array(*[F.lit(s) for s in starts[:-1]]), run)
    number = offset + F.col(_POSITION).bitwiseAND((1 << _ROW_BITS) - 1) + 1
    return stored.select(number.cast("bigint").alias(key), *[F.col(f"`{c}`") for c in rows.columns])


def _hashes(fact: DataFrame, left: list[Column], lookup: DataFrame, right: list[str]) -> tuple[Column, Column] | None:
    """Hashes of both sides' keys that agree wherever the keys do, or None where types do not allow it."""
    ours, theirs = [], []
    for mine, name in zip(left, right):
        kinds = [fact.select(mine).schema[0].dataType, lookup.schema[name].dataType]
        if all(isinstance(k, _WHOLE) for k in kinds):
            ours.append(mine.cast("bigint"))
            theirs.append(F.col(name).cast("bigint"))
        elif kinds[0] == kinds[1] and kinds[0] in _PLAIN:
            ours.append(mine)
            theirs.append(F.col(name))
        else:
            return None
    return F.xxhash64(*ours), F.xxhash64(*theirs)


def heavy_keys(fact: DataFrame, key: Column) -> DataFrame:
    """(heavy, copies): hashes that hold more than one in HEAVY_KEYS rows, and the tasks that each is to fill.

    One pass over the key columns with a mergeable counting sketch. A key gets as many copies as its share
    of the partitions, so all copies together are no more than the partitions and the heavy keys.
    """
    spark = fact.sparkSession
    top = F.expr(f"approx_top_k(h, {HEAVY_KEYS}, {_TRACKED})")
    seen = fact.select(key.alias("h")).agg(top.alias("top"), F.count("*").alias("n")).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = [(r["item"], r["count"]) for r in seen["top"] or [] if r["item"] is not None and r["count"] * HEAVY_KEYS > seen["n"]]
    rows = [(h, max(2, ceil(count * partitions / seen["n"]))) for h, count in heavy]
    return spark.createDataFrame(rows, "heavy bigint, copies int")


def attach_key(
    fact: DataFrame,
    dim: DataFrame,
    on: list[tuple[str | Column, str]],
    key: str,
    null_safe: bool = False,
    broadcast_rows: int | None = None,
    rename: str | None = None,
) -> DataFrame:
    """Left join `dim`'s key to `fact` on pairs (fact column, dim column).

    `null_safe` lets null match null. The dim must be unique on its columns; the result then has
    exactly the fact's rows. A dim that is counted small is broadcast and the fact is not moved.
    A bigger one is joined by shuffle. The fact's keys are counted first, in a sketch; rows of a heavy key are
    spread over several tasks by a salt, and only what the lookup holds for heavy keys is copied. The list of heavy
    keys has at most HEAVY_KEYS rows, which is why it may be broadcast. Keys of floating or differing types
    have no common hash; then the whole lookup is copied SALTS times.
    The salt is a hash of the row: a task that is run again sends each row where it went before.
    Exact copies of a row share a salt; a partition they overfill is split by the skew join.
    """
    names = [f"__on_{i}" for i in range(len(on))]
    lookup = dim.select(
        *[F.col(f"`{d}`").alias(n) for n, (_, d) in zip(names, on)],
        F.col(key).alias(rename or key),
    )

    left = [F.col(f"`{f}`") if isinstance(f, str) else f for f, _ in on]
    pairs = [mine.eqNullSafe(F.col(n)) if null_safe else mine == F.col(n) for mine, n in zip(left, names)]
    condition = reduce(and_, pairs)
    small = fits_broadcast(lookup) if broadcast_rows is None else fits_broadcast(lookup, broadcast_rows)
    if small:
        return fact.join(F.broadcast(lookup), condition, "left").drop(*names)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
    hashes = _hashes(fact, left, lookup, names)
    if hashes is None:
        salted = fact.withColumn("__salt", F.pmod(row, F.lit(SALTS)))
        copies = lookup.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    else:
        heavy = F.broadcast(heavy_keys(fact, hashes[0]).select(F.col("heavy").alias("__heavy"), F.col("copies").alias("__copies")))
        known = fact.join(heavy, hashes[0] == F.col("__heavy"), "left")
        salted = known.withColumn("__salt", F.coalesce(F.pmod(row, F.col("__copies")), F.lit(0).cast("bigint")))
        copied = lookup.join(heavy, hashes[1] == F.col("__heavy"), "left")
        copies = copied.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.coalesce("__copies", F.lit(1)) - 1)))
        salted, copies = salted.drop("__heavy", "__copies"), copies.drop("__heavy", "__copies")
    condition = condition & (F.col("__salt") == F.col("__copy").cast("bigint"))
    return salted.join(copies, condition, "left").drop("__salt", "__copy", *names)


def kept_keys(rows: DataFrame, path: str, key: str, natural: list[str]) -> DataFrame:
    """Prefix distinct `rows` with the keys that the registry at `path` keeps for their `natural` columns.

    What the registry does not know is numbered on from its highest key, in the order of `natural`, and appended; nothing
    in it is ever changed, so a key stays with its row for good, also while the row is away. An append that was
    cut off leaves fewer rows, which the next run numbers anew. One job at a time may extend a registry.
    """
    spark = rows.sparkSession
    rows = store(rows, f"{key}_rows")
    unseen, last = rows.select(*natural).distinct(), 0
    pairs = [(c, c) for c in natural]
    if exists(spark, path):
        known = spark.read.parquet(path)
        last = known.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
        unseen = attach_key(unseen, known, pairs, key, null_safe=True).filter(F.col(key).isNull()).drop(key)
    fresh = dense_key(unseen, key, natural)
    fresh.withColumn(key, F.col(key) + last).write.mode("append").parquet(path)
    keyed = attach_key(rows, spark.read.parquet(path), pairs, key, null_safe=True)
    return keyed.select(key, *[F.col(f"`{c}`") for c in rows.columns])
