"""Near duplicates by SimHash: texts whose fingerprints differ in few bits.

A fingerprint's 64 bits are cut into blocks. Two fingerprints that differ in at most `distance` bits
agree on all but `distance` of the blocks, so every choice of that many agreeing blocks is a key under which
close fingerprints meet. The fingerprints under a key are compared and leave a spanning forest of
the links among them, never all pairs. Copies of one fingerprint count once.

A key that more fingerprints share than a task should hold is left to a second way, which is exact as
well: two fingerprints within four bits of each other both lie within two bits of some third value,
so each is sent to all values within half the distance, and those that meet are linked to the least.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.components import components
from martloom.llm.rows import ROW, byte_texts, numbered, word_runs
from martloom.storage import store

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Blocks a fingerprint is cut into; close ones agree on all but DISTANCE of them.
BLOCKS = 7
#: The most fingerprints under one key that are compared in a task, and about as many rows as a task gets.
CROWD = 4096
BUCKET_ROWS = 100_000


def fingerprint(data: bytes) -> int:
    """The SimHash of a text's shingles as an unsigned number; 0 when it has no word."""
    ones, n, words = np.zeros(64, np.int64), 0, []
    for words in word_runs(data, bytes.lower, SHINGLE - 1):
        if len(words) >= SHINGLE:
            joined = b" ".join(words)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1) - 1
            starts = (ends - lengths)[: len(words) - SHINGLE + 1].tolist()
            found, seen = _ones([joined[a:b] for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())])
            ones, n = ones + found, n + seen
    if not n and words:
        ones, n = _ones([b" ".join(words)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def _ones(shingles: list[bytes]) -> tuple[np.ndarray, int]:
    """How many of the shingles' hashes have each bit, and how many there are."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", len(shingles))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return ones, len(hashes)


def with_fingerprints(rows: DataFrame, key: str, text: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """(carried columns, id, fp): fp is the fingerprint as a signed number."""
    narrow = rows.select(*carried, rows[key].alias("id"), rows[text].alias("text"))

    def work(batches):
        for batch in batches:
            prints = np.array([fingerprint(x) for x in byte_texts(batch)], np.uint64).view(np.int64)
            yield pa.record_batch([*batch.columns[:-1], pa.array(prints)], [*batch.schema.names[:-1], "fp"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(work, f"{kinds}, fp BIGINT")


def _masks(blocks: int, distance: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    chosen = [sum(c) for c in combinations(parts, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def forest(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges that connect what links of at most `distance` bits connect; one fewer than nodes per tree."""
    rest, edges = prints, []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = np.bitwise_count(rest ^ node) <= distance
            reached = rest[near]
            edges += [(int(node), int(x)) for x in reached]
            queue += list(reached)
            rest = rest[~near]
    return edges


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, crowd: int = CROWD) -> DataFrame:
    """(a, b) of fingerprints (distinct, stored, column fp) that connect all within `distance` bits."""
    if distance % 2:
        raise ValueError("an even distance is needed: two halves of it must add up to it")
    masked = [
        F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
        for i, m in enumerate(_masks(blocks, distance))
    ]
    keyed = F.explode(F.array(*masked))
    keys = prints.select("fp", keyed.alias("key")).select("fp", "key.m", "key.k")
    shared = store(keys.groupBy("m", "k").agg(F.count("*").alias("n")).filter("n > 1"), "simhash_keys")
    met = keys.join(shared.filter(F.col("n") <= crowd), ["m", "k"]).select("fp", "m", "k")
    rows = shared.filter(F.col("n") <= crowd).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, -(-rows // BUCKET_ROWS))

    def connect(table: pa.Table) -> pa.Table:
        m, k, fp = (table.column(c).to_numpy() for c in ("m", "k", "fp"))
        order = np.lexsort((fp, k, m))
        m, k, fp = m[order], k[order], fp[order].view(np.uint64)
        first = np.flatnonzero(np.append(True, (m[1:] != m[:-1]) | (k[1:] != k[:-1])))
        size = np.diff(np.append(first, len(fp)))
        twos = first[size == 2]
        near = twos[np.bitwise_count(fp[twos] ^ fp[twos + 1]) <= distance]
        edges = [(fp[near].view(np.int64), fp[near + 1].view(np.int64))]
        for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            found = np.array(forest(fp[at : at + n], distance), np.uint64).reshape(-1, 2).view(np.int64)
            edges.append((found[:, 0], found[:, 1]))
        a, b = (np.concatenate([e[i] for e in edges]) for i in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    bucket = F.pmod(F.xxhash64("m", "k"), F.lit(buckets)).alias("bucket")
    found = met.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(connect, "a BIGINT, b BIGINT")
    crowded = shared.filter(F.col("n") > crowd)
    if crowded.isEmpty():
        return found
    # distinct fingerprints of crowded keys; any two of them that are close meet at a value between
    many = store(keys.join(crowded, ["m", "k"], "left_semi").select("fp").distinct(), "crowded_prints")
    half = distance // 2
    flips = [sum(1 << b for b in c) for r in range(half + 1) for c in combinations(range(64), r)]
    flips = [x - (1 << 64) if x >> 63 else x for x in flips]
    between = many.select("fp", F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip"))
    between = between.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z"))
    least = store(between.groupBy("z").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).filter("least < most"), "between")
    meeting = between.join(least, "z").select(F.col("fp").alias("a"), F.col("least").alias("b")).filter("a <> b")
    return found.unionByName(meeting.distinct())


def _rooted(prints: DataFrame, distance: int, blocks: int, crowd: int) -> DataFrame:
    """(fp, root, component_id) for every fingerprint of stored `prints` (id, fp)."""
    distinct = store(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash_distinct")
    roots = store(components(links(distinct.select("fp"), distance, blocks, crowd)), "simhash_roots")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    rooted = store(rooted.select("fp", F.coalesce("root", "fp").alias("root"), "first"), "simhash_rooted")
    ids = store(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash_components")
    return store(rooted.join(ids, "root").select("fp", "root", "component_id"), "simhash_classes")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE, blocks: int = BLOCKS, crowd: int = CROWD
) -> DataFrame:
    """One row per row of `docs`: key, fingerprint (hex), component_id.

    Texts with fewer words than a shingle have one shingle of all; texts without words, null among
    them, have fingerprint zero. The least key of a component is its id; null keys are passed over
    unless there is no other. Repeated rows share a component. An empty table gives no rows.
    """
    prints = store(with_fingerprints(docs, key, text), "simhash_prints")
    joined = prints.join(_rooted(prints, distance, blocks, crowd), "fp")
    return joined.select(F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def without_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE, blocks: int = BLOCKS, crowd: int = CROWD
) -> DataFrame:
    """One row of each component of `docs`, that with the least key, with its columns as they were, whatever their names.

    Null, empty and repeated rows as in `near_duplicates`; a null key comes last, and of repeated keys one row stays. Long texts are
    read whole. An empty table gives no rows.
    """
    rows = numbered(docs.select(F.struct("*").alias("doc")), "simhash_input")
    plain = rows.select(ROW, F.col("doc").getField(key).alias("key"), F.col("doc").getField(text).alias("text"))
    prints = store(with_fingerprints(plain, "key", "text", (ROW,)), "simhash_prints")
    roots = _rooted(prints, distance, blocks, crowd).select("fp", "root")
    first = F.min(F.struct(F.col("id").isNull(), "id", ROW)).alias("first")
    kept = prints.join(roots, "fp").groupBy("root").agg(first).select(F.col(f"first.{ROW}").alias(ROW))
    return rows.join(kept, ROW, "left_semi").select("doc.*")
