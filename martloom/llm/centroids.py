"""Exact k-means over vectors that are cut by columns.

Vectors are stored in chunks of rows, and each chunk as blocks of columns, its shards. A round has two
steps. A shard's distances to its slices of the centroids are exact parts of the distances; parts of one
chunk are added up, first where they meet in a task and then by key, and the smallest total names
the cluster of each row. Then the clusters go back to the shards of their chunk, and each block of columns adds up
its own components per cluster, which gives its slice of the next centroids.

No task needs a whole vector to compare it, so long vectors are cut into as many shards as wanted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import vectors
from martloom.storage import store

CLUSTERS = 8
ROUNDS = 10
LENGTH = 64
#: Columns in a shard, and rows in a chunk.
SHARD_COLUMNS = 16
CHUNK_ROWS = 1024

#: How matrices are sent: the narrowest of these that holds them, named by one leading byte.
KINDS = [np.dtype("<i2"), np.dtype("<i4"), np.dtype("<i8")]
WIDE = len(KINDS)


def packed(x: np.ndarray) -> bytes:
    """Whole numbers, row after row."""
    most = largest = vectors.largest(x)
    for tag, kind in enumerate(KINDS):
        if most <= np.iinfo(kind).max:
            return bytes([tag]) + x.astype(kind).tobytes()
    digits = largest.bit_length() // 8 + 1
    head = bytes([WIDE]) + digits.to_bytes(2, "little")
    return head + b"".join(int(v).to_bytes(digits, "little", signed=True) for v in x.reshape(-1))


def unpacked(data: bytes, rows: int) -> np.ndarray:
    """The matrix again, as int64 or, beyond that, objects."""
    if data[0] < WIDE:
        return np.frombuffer(data, KINDS[data[0]], offset=1).astype(np.int64).reshape(rows, -1)
    digits = int.from_bytes(data[1:3], "little")
    numbers = [int.from_bytes(data[i : i + digits], "little", signed=True) for i in range(3, len(data), digits)]
    return np.array(numbers, object).reshape(rows, -1)


def doubles(x: np.ndarray) -> np.ndarray:
    """Components as doubles; all of them once were."""
    return x.astype(np.float64)


def _shards(kept: DataFrame, length: int, shard_columns: int, chunk_rows: int) -> DataFrame:
    """A row per chunk and shard; shard -1 has the keys of the chunk."""
    own = kept.schema["key"].dataType.simpleString()
    names = ["chunk", "shard", "n", "data", "keys"]

    def cut(batches):
        part, made = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for start in range(0, batch.num_rows, chunk_rows):
                some = batch.slice(start, chunk_rows)
                x = vectors.scaled(vectors.matrix(some.column("raw"), length))
                x = x if vectors.largest(x) < vectors.EXACT else vectors.whole(x)
                slices = [packed(x[:, c : c + shard_columns]) for c in range(0, length, shard_columns)]
                rows = len(slices) + 1
                keys = pa.array([some.column("key").to_pylist(), *[None] * len(slices)], pa.list_(some.schema.field("key").type))
                yield pa.record_batch(
                    [
                        pa.array([part + made] * rows, pa.int64()),
                        pa.array(range(-1, len(slices)), pa.int32()),
                        pa.array([some.num_rows] * rows, pa.int32()),
                        pa.array([None, *slices], pa.binary()),
                        keys,
                    ],
                    names,
                )
                made += 1

    return kept.mapInArrow(cut, f"chunk BIGINT, shard INT, n INT, data BINARY, keys ARRAY<{own}>")


_TOTALS = "chunk BIGINT, n INT, data BINARY"


def _total(chunk: int, n: int, distances: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([chunk], pa.int64()), pa.array([n], pa.int32()), pa.array([packed(distances)], pa.binary())]
    return pa.record_batch(columns, ["chunk", "n", "data"])


def _clusters(shards: DataFrame, slices: list[np.ndarray]) -> DataFrame:
    """A row per chunk: its rows, the number of the nearest centroid of each, and their distances."""

    def compare(batches) -> Iterator[pa.RecordBatch]:
        chunk, n, total = None, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] != chunk:
                    if chunk is not None:
                        yield _total(chunk, n, total)
                    chunk, n, total = row["chunk"], row["n"], 0
                x = doubles(unpacked(row["data"], n))
                total = total + vectors.squared_distances(x, slices[row["shard"]])
        if chunk is not None:
            yield _total(chunk, n, total)

    def nearest(table: pa.Table) -> pa.Table:
        n = table.column("n")[0].as_py()
        total = sum(unpacked(x, n) for x in table.column("data").to_pylist())
        columns = {
            "chunk": table.column("chunk").slice(0, 1),
            "n": table.column("n").slice(0, 1),
            "clusters": pa.array([total.argmin(1).astype("<i4").tobytes()], pa.binary()),
            "distances": pa.array([packed(total.min(1))], pa.binary()),
        }
        return pa.table(columns)

    parts = shards.filter("shard >= 0").select("chunk", "shard", "n", "data").mapInArrow(compare, _TOTALS)
    return parts.groupBy("chunk").applyInArrow(nearest, "chunk BIGINT, n INT, clusters BINARY, distances BINARY")


def _moved(shards: DataFrame, clusters: DataFrame, slices: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The slices of the next centroids; those of a cluster without rows stay."""

    def add(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = doubles(unpacked(row["data"], row["n"]))
                x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
                assigned = np.frombuffer(row["clusters"], "<i4")
                sums = vectors.sums_by_entry(x, assigned, len(slices[0]))
                yield vectors.sum_rows([(row["shard"], entry, digit, n, s) for entry, n, digit, s in sums])

    both = shards.filter("shard >= 0").select("chunk", "shard", "n", "data").join(clusters.select("chunk", "clusters"), "chunk")
    sums = vectors.added(both.select("shard", "n", "data", "clusters").mapInArrow(add, vectors.SUMS), width)
    moved = [s.copy() for s in slices]
    for (shard, cluster), (n, totals) in sums.items():
        columns = moved[shard].shape[1]
        moved[shard][cluster] = [t // n for t in totals[:columns]]
    return moved


def clustered(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    length: int = LENGTH,
    salt: str = "3",
    shard_columns: int = SHARD_COLUMNS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One row per kept vector: key, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Components x become floor(1024 * x). Centroids start at the vectors with the smallest sha256 of
    `salt:key` (equal ones by their components; a null key counts as empty text; fewer vectors give fewer clusters)
    and move `rounds` times to the mean of their vectors, rounded down; then vectors are assigned once
    more. Ties go to the smaller number. Distances are squared; one beyond a long, and a sum with it, is null.

    Vectors that are null, not of `length` components or hold a null or non-finite one are dropped.
    Repeated rows count and return each for itself. Long vectors are cut into more shards. An empty table, or one without
    a usable vector, gives no rows. Other columns, whatever their names, are left aside.
    """
    spark, own = table.sparkSession, table.schema[key].dataType.simpleString()
    result = f"`{key}` {own}, cluster INT, distance BIGINT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING"
    kept = table.filter(vectors.usable(table[vector]) & (F.size(table[vector]) == length)).select(
        table[key].alias("key"), table[vector].cast("array<double>").alias("raw")
    )
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    start = kept.orderBy(F.sha2(name, 256), "key", "raw").limit(clusters).collect()
    if not start or not length:
        return spark.createDataFrame([], result)
    first = vectors.whole(vectors.scaled(np.array([r["raw"] for r in start], np.float64)))
    slices = [first[:, c : c + shard_columns] for c in range(0, length, shard_columns)]
    shards = store(_shards(kept, length, shard_columns, chunk_rows), "shards")
    width = min(shard_columns, length)
    for done in range(rounds):
        slices = _moved(shards, store(_clusters(shards, slices), f"clusters_{done}"), slices, width)

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                keys = batch.column("keys").slice(i, 1).flatten()
                found = unpacked(row["distances"], row["n"])[:, 0]
                assigned = pa.array(np.frombuffer(row["clusters"], "<i4"), pa.int32())
                yield pa.record_batch([keys, assigned, vectors.longs(found)], ["key", "cluster", "distance"])

    keys = shards.filter("shard < 0").select("chunk", "keys")
    placed = keys.join(store(_clusters(shards, slices), "clusters"), "chunk").select("keys", "n", "clusters", "distances")
    placed = store(placed.mapInArrow(rows, f"key {own}, cluster INT, distance BIGINT"), "placed")
    # One row per cluster, whose number is a parameter.
    inertia = {r["cluster"]: r["d"] for r in placed.groupBy("cluster").agg(vectors.long_sum(F.col("distance")).alias("d")).collect()}
    whole = None if None in inertia.values() else sum(inertia.values())
    whole = whole if whole is not None and whole < vectors.LONG else None
    described = []
    for cluster in range(len(first)):
        text = ",".join(str(v) for s in slices for v in s[cluster].tolist())
        described.append((cluster, inertia.get(cluster), whole, hashlib.sha256(text.encode()).hexdigest()))
    lookup = spark.createDataFrame(described, "cluster INT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING")
    joined = placed.join(F.broadcast(lookup), "cluster")
    return joined.select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
