"""Exact duplicates by naming blocks and then pairs of names, until each text has one name.

Texts are cut into blocks of fixed size. Distinct blocks are sorted and numbered; equal numbers mean
equal blocks. Adjacent numbers are paired and the distinct pairs sorted and numbered again, which
halves the length each round. A text ends with one number and the round it ended in, and two texts
share both only when they are equal: there is no hash to trust at the end.

Block contents are moved once, by the check that a 64-bit hash stands for one content only. Where it
does, the hash takes the place of the content in sorting and joining; contents whose hash is shared
are named by content. Later rounds move numbers only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.rows import ROW, SPACES, numbered, text_of
from martloom.operators.keys import dense_key
from martloom.storage import store

BLOCK_BYTES = 2048


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space."""
    return F.regexp_replace(text, SPACES + "+", " ")


def _blocks(data: Column, size: int) -> Column:
    last = F.greatest(F.ceil(F.octet_length(data) / size).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def text_names(
    rows: DataFrame,
    text: str,
    block_bytes: int = BLOCK_BYTES,
    hashed: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """(__row, round, name) for stored `rows` with a __row number; equal texts share round and name."""
    data = rows.select(ROW, text_of(rows, text).cast("binary").alias("data"))
    blocks = data.select(ROW, F.posexplode(_blocks(F.col("data"), block_bytes)).alias("pos", "block"))
    blocks = blocks.select(ROW, "pos", hashed(F.col("block")).alias("h"), "block")
    contents = blocks.select("h", "block").distinct()
    shared = store(contents.groupBy("h").count().filter("count > 1").select("h"), "shared_hashes")
    found = blocks.select(ROW, "pos", "h").withColumn("variant", F.lit(0).cast("long"))
    if not shared.isEmpty():
        by_content = dense_key(contents.join(shared, "h", "left_semi"), "variant", ["h", "block"])
        unique = found.join(shared, "h", "left_anti")
        named = blocks.join(shared, "h", "left_semi").join(by_content, ["h", "block"])
        found = unique.unionByName(named.select(ROW, "pos", "h", "variant"))
    found = store(found, "block_hashes")
    level = _renamed(found, ["h", "variant"], "round_0")

    ends, step = [], 0
    counts = level.groupBy(ROW).agg((F.max("pos") + 1).alias("n"))
    level = store(level.join(counts, ROW), "round_0_counted")
    while True:
        ends.append(level.filter("n = 1").select(ROW, F.lit(step).alias("round"), "name"))
        longer = level.filter("n > 1")
        if longer.isEmpty():
            break
        half = F.shiftright("pos", 1)
        pairs = longer.groupBy(ROW, half.alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(0)).alias("right"),
            F.shiftright(F.max("n") + 1, 1).alias("n"),
        )
        step += 1
        level = _renamed(store(pairs, f"pairs_{step}"), ["left", "right"], f"round_{step}")
        level = store(level.select(ROW, "pos", "n", "name"), f"round_{step}_named")
    return reduce(DataFrame.unionByName, ends)


def _renamed(rows: DataFrame, by: list[str], label: str) -> DataFrame:
    """`rows` with `name`, the rank of its values of `by`; a frequent value is split by the skew join."""
    ranks = dense_key(rows.select(*by).distinct(), "name", by)
    return rows.join(ranks.select(F.col("name").cast("long").alias("name"), *by), by).drop(*by)


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of `docs`: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after white-space runs became one space. Null text counts
    as empty, and empty texts equal each other. The smallest key of a group stays (null keys come
    last); if several rows of the group have it, one of them stays. An empty table gives no rows.
    Other columns are not read.
    """
    source = docs.select(docs[key].alias("id"), normalised(text_of(docs, text)).alias("body"))
    return _classed(numbered(source, "exact_dedup_rows"), block_bytes).select(
        F.col("id").alias(key), "keep_id", "group_size", "kept", "text_sha256"
    )


def _classed(rows: DataFrame, block_bytes: int) -> DataFrame:
    names = text_names(rows, "body", block_bytes)
    own = rows.select(ROW, "id", F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"))
    named = store(own.join(names, ROW), "exact_dedup_named")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", ROW)
    groups = named.groupBy("round", "name").agg(F.count("*").alias("group_size"), F.min(first).alias("first"))
    # read back, so that both sides of the join are dealt for it alone and a large group is split
    groups = store(groups, "exact_dedup_groups")
    return named.join(groups, ["round", "name"]).select(
        ROW,
        "id",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col(ROW) == F.col(f"first.{ROW}")).alias("kept"),
        "text_sha256",
    )


def without_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of `docs` that stay, all columns as they were, whatever their names.

    Null text counts as empty, and empty texts equal each other. Of equal texts the row with the smallest key stays, a null key last;
    of repeated rows one. Long texts are compared block by block. An empty table gives no rows.
    """
    rows = numbered(docs.select(F.struct("*").alias("doc")), "exact_dedup_input")
    field = F.col("doc").getField
    body = normalised(F.coalesce(field(text).cast("string"), F.lit("")))
    kept = _classed(rows.select(ROW, field(key).alias("id"), body.alias("body")), block_bytes).filter("kept").select(ROW)
    return rows.join(kept, ROW, "left_semi").select("doc.*")
