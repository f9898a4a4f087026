"""WARC archives: writing them with revisits, and reading them back by verified chains of boundaries.

Archives are read in splits. Spark's text reader takes the version line as its separator, so each piece is
what stands between two version lines, and the lengths of the pieces say where in the file each
line is. Every piece that looks like a record names the place where the next record must begin. A
payload may contain version lines and whole false records, so what looks like a record need not be one:
by pointer jumping from the start of each file, only the places that the chain reaches are kept.
Pieces that the chain does not reach are payload, and are put back into the record they stand in.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martloom.llm.rows import text_of
from martloom.storage import store

# Fixed values of the format.
VERSION = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_REVISITED = 100
DATE = "2024-01-01T00:00:00Z"

FIELDS = ("WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Payload-Digest", "Content-Length")


def _urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.url_encode(key.cast("string")), F.lit(">"))


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", text: str = "html", url: str = "url", least: int = LEAST_REVISITED
) -> None:
    """One record per row of `pages`, in archives under `path`, one per task.

    Of equal payloads of at least `least` bytes those with the smallest key are responses and the others
    revisit it; a row without key is always a response. Null text is an empty payload.
    """
    body = text_of(pages, text)
    rows = pages.select(pages[key].alias("id"), pages[url].cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumns({"digest": F.sha2(F.col("body").cast("binary"), 256), "size": F.octet_length("body")})
    seen = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    seen = store(seen.filter("n > 1").select("digest", "first"), "warc_repeated")
    rows = rows.join(seen, "digest", "left")
    again = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit("\r\n\r\n")
    )
    block = F.when(again, http).otherwise(F.concat(http, "body"))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    record = F.concat(
        F.lit(VERSION),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.coalesce(_urn(F.col("id")), F.lit("<urn:page:>"))),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "")),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Refers-To", F.when(again, _urn(F.col("first")))),
        line("WARC-Profile", F.when(again, F.lit(PROFILE))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )
    rows.select(record.alias("value")).write.option("lineSep", RECORD_END).text(path)


def _parsed(piece: bytes) -> tuple[dict[str, str], bytes] | None:
    """The fields of a record whose version line went before, and what follows its head."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().decode("latin-1").lower()] = value.strip().decode("latin-1")
    if not fields.get("content-length", "").isdecimal() or "warc-type" not in fields or "warc-record-id" not in fields:
        return None
    return fields, piece[end + 4 :]


def _payload(block: bytes) -> bytes:
    """What follows the HTTP head of a block."""
    return block.partition(b"\r\n\r\n")[2]


_DESCRIBED = (
    "type STRING, record_id STRING, refers_to STRING, declared STRING, length BIGINT, complete BOOLEAN, "
    "payload_bytes BIGINT, payload_digest STRING"
)


def _described(piece: bytes) -> tuple:
    found = _parsed(piece)
    if found is None:
        return (None,) * 8
    fields, rest = found
    size = int(fields["content-length"])
    length = len(VERSION) + len(piece) - len(rest) + size + len(RECORD_END)
    complete = len(rest) >= size
    payload = _payload(rest[:size]) if complete else None
    return (
        fields["warc-type"],
        fields["warc-record-id"],
        fields.get("warc-refers-to"),
        fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        length,
        complete,
        None if payload is None else len(payload),
        None if payload is None else hashlib.sha256(payload).hexdigest(),
    )


_NAMES = [x.split()[0] for x in _DESCRIBED.split(", ")]
_TYPES = [{"STRING": pa.string(), "BIGINT": pa.int64(), "BOOLEAN": pa.bool_()}[x.split()[1]] for x in _DESCRIBED.split(", ")]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", VERSION).text(path)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")
    )


def _scanned(pieces: DataFrame, content: bool) -> DataFrame:
    """(file, split, at, size) of each piece, at counted from its split's first piece, and what it looks like or is."""

    def scan(batches):
        running, at = None, 0
        for batch in batches:
            files, splits = batch.column("file").to_pylist(), batch.column("split").to_pylist()
            values = batch.column("value").cast(pa.binary()).to_pylist()
            places, sizes = [], []
            for file, split, value in zip(files, splits, values):
                if (file, split) != running:
                    running, at = (file, split), 0
                places.append(at)
                sizes.append(len(value))
                at += len(value) + len(VERSION)
            columns = [batch.column("file"), batch.column("split"), pa.array(places, pa.int64()), pa.array(sizes, pa.int64())]
            names = ["file", "split", "at", "size"]
            if content:
                columns, names = [*columns, pa.array(values, pa.binary())], [*names, "content"]
            else:
                found = list(zip(*map(_described, values))) or [()] * len(_NAMES)
                columns += [pa.array(list(c), t) for c, t in zip(found, _TYPES)]
                names = names + _NAMES
            yield pa.record_batch(columns, names)

    layout = "file STRING, split BIGINT, at BIGINT, size BIGINT, " + ("content BINARY" if content else _DESCRIBED)
    return pieces.mapInArrow(scan, layout)


def _reached(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the `candidates` (file, offset, next) on the chain from the start of their file."""
    jumps = store(candidates.select("file", "offset", "next"), "warc_jumps")
    reached = store(jumps.filter("offset = 0").select("file", "offset"), "warc_reached")
    size = reached.count()
    while True:
        onward = reached.join(jumps, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        reached = store(reached.unionByName(onward).distinct(), "warc_reached")
        grown = reached.count()
        if grown == size:
            return reached
        size = grown
        further = jumps.select("file", F.col("offset").alias("next"), F.col("next").alias("after"))
        jumps = store(jumps.join(further, ["file", "next"]).select("file", "offset", F.col("after").alias("next")), "warc_jumps")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under `path`: file, offset, type, record_id, refers_to, declared
    (the digest in its head), payload_bytes and payload_digest of the payload it holds.

    Only records on the chain from the start of their file count; an archive that does not begin with a
    record has none, and one that breaks off has those before the break.
    """
    pieces = _pieces(spark, path)
    found = store(_scanned(pieces, content=False), "warc_pieces")
    totals = found.groupBy("file", "split").agg(F.sum(F.col("size") + len(VERSION)).alias("total"))
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("file", "split", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = found.join(store(bases, "warc_splits"), ["file", "split"])
    placed = store(placed.withColumn("offset", F.col("base") + F.col("at") - len(VERSION)), "warc_placed")
    candidates = placed.filter("length IS NOT NULL AND offset >= 0")
    reached = _reached(candidates.withColumn("next", F.col("offset") + F.col("length")))
    records = candidates.join(reached, ["file", "offset"])
    names = ["file", "offset", "type", "record_id", "refers_to", "declared", "payload_bytes", "payload_digest"]
    broken = store(records.filter("NOT complete"), "warc_divided")
    if broken.isEmpty():
        return records.select(*names)

    # payload pieces, each under the record it stands in: those after a divided record up to its end
    inner = placed.join(reached, ["file", "offset"], "left_anti").select("file", "split", "at", "offset", F.lit(None).cast("bigint").alias("end"))
    heads = broken.select("file", "split", "at", "offset", (F.col("offset") + F.col("length")).alias("end"))
    order = W.partitionBy("file").orderBy("offset").rowsBetween(W.unboundedPreceding, 0)
    head = F.last(F.when(F.col("end").isNotNull(), F.struct(F.col("offset").alias("start"), "end")), ignorenulls=True)
    owned = inner.unionByName(heads).withColumn("head", head.over(order)).filter("offset < head.end")
    owned = owned.select("file", "split", "at", "offset", F.col("head.start").alias("start"))
    parts = _scanned(pieces, content=True).join(owned, ["file", "split", "at"])
    whole = parts.groupBy("file", "start").agg(F.sort_array(F.collect_list(F.struct("offset", "content"))).alias("parts"))

    def mend(batches):
        for batch in batches:
            contents = [VERSION.encode().join(p["content"] for p in x) for x in batch.column("parts").to_pylist()]
            found = list(zip(*map(_described, contents))) or [()] * len(_NAMES)
            columns = [pa.array(list(c), t) for c, t in zip(found, _TYPES)]
            yield pa.record_batch([batch.column("file"), batch.column("start"), *columns], ["file", "offset", *_NAMES])

    mended = whole.mapInArrow(mend, "file STRING, offset BIGINT, " + _DESCRIBED)
    return records.filter("complete").select(*names).unionByName(mended.select(*names))


def round_trip(pages: DataFrame, path: str, key: str = "page_id", text: str = "html", url: str = "url") -> DataFrame:
    """One row per row of `pages`, from the archives written to `path`: key, payload_bytes, payload_digest,
    record_type, refers_to. A revisit has the payload of the response it refers to.

    An empty table gives no rows. Repeated rows with the smallest key are all responses.
    """
    write_archives(pages, path, key, text, url)
    records = store(read_archives(pages.sparkSession, path), "warc_records")
    kind = pages.schema[key].dataType
    own = lambda urn: F.url_decode(F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit(""))).cast(kind)
    responses = records.filter("type = 'response'")
    columns = ["payload_bytes", "payload_digest"]
    answered = responses.select(
        own("record_id").alias(key), *columns, F.col("type").alias("record_type"), F.lit(None).cast(kind).alias("refers_to")
    )
    held = responses.select(F.col("record_id").alias("refers_to"), F.col("payload_digest").alias("declared"), *columns).distinct()
    revisits = records.filter("type = 'revisit'").select("record_id", "refers_to", "declared", F.col("type").alias("record_type"))
    revisits = revisits.join(held, ["refers_to", "declared"], "left")
    return answered.unionByName(
        revisits.select(own("record_id").alias(key), *columns, "record_type", own("refers_to").alias("refers_to"))
    )
