"""CSV files with quoted line breaks, read in splits.

Whether a line starts a record depends on everything before it: on whether a quoted field is still open. A
line by itself says how it ends for either start, open or closed, and such functions of two states can be put
together. So a file is read twice. The first pass folds each split to what it does with either start, and
counts the records that would begin in it; running those folds together over the splits of a file gives each split its
real start and the number of records before it. The second pass numbers the lines of all splits at
once. Records of one line, nearly all, are parsed where they are; only lines of longer records are brought
together, also across splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.storage import fits_broadcast, store

CSV = {"escape": '"'}

# Field by field: a closed quoted field, or one that begins without a quote and may hold some.
_CLOSED = r'"[^"]*+(?:""[^"]*+)*+"|[^",][^,]*+'
# What is left of a field that was open before the line, up to the next one.
_REST = r'^[^"]*+(?:""[^"]*+)*+"[^,]*+,?'

OPEN = "open"
_NUMBERED = (
    "file STRING, start BIGINT, place BIGINT, closed_before BOOLEAN, closed_after BOOLEAN, closed_n BIGINT, "
    "open_before BOOLEAN, open_after BOOLEAN, open_n BIGINT"
)


def _left_open(line: Column) -> Column:
    """Whether a line that starts outside quotes ends inside."""
    return F.regexp_replace(line, _CLOSED, "").contains('"')


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files with their split, and how each ends by how it starts."""
    text = spark.read.option("lineSep", "\n").text(path)
    line = F.col("value")
    rest = F.regexp_replace(line, _REST, "")
    still = ~line.rlike(_REST)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.when(~line.contains('"'), False).otherwise(_left_open(line)).alias("from_closed"),
        F.when(~line.contains('"'), True).otherwise(still | _left_open(rest)).alias("from_open"),
        F.regexp_replace(line, "\r$", "").eqNullSafe("").alias("blank"),
        "value",
    )


def ends(from_closed: np.ndarray, from_open: np.ndarray, start: bool) -> np.ndarray:
    """Whether quotes are open after each of a run of lines, from the state before the first."""
    place = np.arange(len(from_closed))
    certain = from_closed == from_open
    last = np.maximum.accumulate(np.where(certain, place, -1))
    turns = np.cumsum(from_closed & ~from_open)
    before = np.where(last >= 0, from_closed[last], start)
    return before ^ ((turns - np.where(last >= 0, turns[last], 0)) % 2 == 1)


def _numbered(lines: DataFrame, keep_text: bool) -> DataFrame:
    """Lines with their place in the split, and for either start of the split the states around the line and the records begun."""

    def number(batches) -> Iterator[pa.RecordBatch]:
        split, place, state, begun = None, 0, [False, True], [0, 0]
        for batch in batches:
            files, starts = batch.column("file"), np.asarray(batch.column("start"))
            named = np.asarray(files.dictionary_encode().indices)
            changes = np.flatnonzero((np.diff(named) != 0) | (np.diff(starts) != 0)) + 1
            for a, b in zip([0, *changes], [*changes, batch.num_rows]):
                some = batch.slice(a, b - a)
                mine = (files[int(a)].as_py(), int(starts[a]))
                if mine != split:
                    split, place, state, begun = mine, 0, [False, True], [0, 0]
                flags = {c: np.asarray(some.column(c).cast(pa.int8())).astype(bool) for c in ("from_closed", "from_open", "blank")}
                columns = [some.column("file"), some.column("start"), pa.array(np.arange(place, place + b - a))]
                for i in (0, 1):
                    after = ends(flags["from_closed"], flags["from_open"], state[i])
                    before = np.append(state[i], after[:-1])
                    counted = begun[i] + np.cumsum(~before & ~flags["blank"])
                    columns += [pa.array(before), pa.array(after), pa.array(counted)]
                    state[i], begun[i] = bool(after[-1]), int(counted[-1])
                place += b - a
                yield pa.record_batch([*columns, *([some.column("value")] if keep_text else [])], names)

    layout = _NUMBERED + (", value STRING" if keep_text else "")
    names = [c.split()[0] for c in layout.split(", ")]
    return lines.select("file", "start", "from_closed", "from_open", "blank", *(["value"] if keep_text else [])).mapInArrow(number, layout)


def _split_starts(numbered: DataFrame) -> DataFrame:
    """A row per split: whether quotes are open where it starts, and how many records began before it in its file."""
    last = F.max_by(F.struct("closed_after", "open_after", "closed_n", "open_n"), "place")
    folds = numbered.groupBy("file", "start").agg(last.alias("f")).select("file", "start", "f.*")
    # One row per split is all that is ordered here.
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turn = F.col("closed_after") & ~F.col("open_after")
    folds = folds.withColumn("turns", F.sum(turn.cast("int")).over(Window.partitionBy("file").orderBy("start")))
    certain = F.when(F.col("closed_after") == F.col("open_after"), F.struct(F.col("closed_after").alias("is_open"), "turns"))
    known = folds.select("*", F.last(certain, ignorenulls=True).over(earlier).alias("c"), F.lag("turns", 1, 0).over(Window.partitionBy("file").orderBy("start")).alias("t"))
    turned = (F.col("t") - F.coalesce(F.col("c.turns"), F.lit(0))) % 2 == 1
    opened = known.withColumn(OPEN, F.coalesce(F.col("c.is_open"), F.lit(False)) != turned)
    begun = F.sum(F.when(F.col(OPEN), F.col("open_n")).otherwise(F.col("closed_n"))).over(earlier)
    return opened.select("file", "start", OPEN, F.coalesce(begun, F.lit(0)).alias("records_before"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files as (file, record, body): the number of the record in its file, from 1, and its text.

    A file may be one or many; each is read in splits. Blank lines between records are no records. Quotes are
    escaped by doubling; a quote inside a field that does not begin with one is plain text. A record is put
    together in one task, so a quote that is never closed makes one record of the rest of its file.
    """
    lines = _lines(spark, path)
    starts = store(_split_starts(_numbered(lines, keep_text=False)), "split_starts")
    looked_up = F.broadcast(starts) if fits_broadcast(starts) else starts
    placed = _numbered(lines, keep_text=True).join(looked_up, ["file", "start"], "left")
    # Both passes cut the files alike unless the cluster changed its size in between.
    known = F.when(F.col(OPEN).isNull(), F.raise_error(F.lit("splits changed between passes; set spark.sql.files.minPartitionNum"))).otherwise(F.col(OPEN))
    pick = lambda name: F.when(known, F.col(f"open_{name}")).otherwise(F.col(f"closed_{name}"))
    told = placed.select(
        "file", "start", "place", "value", pick("before").alias("before"), pick("after").alias("after"),
        (F.col("records_before") + pick("n")).alias("record"),
    )
    body = F.regexp_replace("value", "\r$", "")
    single = told.filter(~F.col("before") & ~F.col("after") & (body != "")).select("file", "record", body.alias("body"))
    parts = F.array_sort(F.collect_list(F.struct("start", "place", "value")))
    longer = told.filter(F.col("before") | F.col("after")).groupBy("file", "record").agg(parts.alias("parts"))
    whole = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["value"]), "\n"), "\r$", "")
    return single.unionByName(longer.select("file", "record", whole.alias("body")))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header in every file, all columns STRING, as the multi-line reader gives it but in splits."""
    names = spark.read.options(**CSV, header=True, multiLine=True).csv(path).columns
    if not names:
        return spark.read.options(**CSV, header=True, multiLine=True).csv(path)
    columns = [f"c{i}" for i in range(len(names))]
    layout = ", ".join(f"{c} STRING" for c in columns)
    rows = read_records(spark, path).filter(F.col("record") > 1).select(F.from_csv("body", layout, CSV).alias("r"))
    return rows.select(*[F.col(f"r.{c}").alias(n) for c, n in zip(columns, names)])
