"""Helpers the text operators share."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.storage import store

#: The bytes that separate words everywhere here: space and \x09 to \x0D.
SPACES = r"[\x20\x09-\x0D]"

ROW = "__row"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once per row however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The column as text, null read as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def numbered(df: DataFrame, label: str) -> DataFrame:
    """`df` stored with a row number that stays the same from now on, whatever else repeats."""
    return store(df.withColumn(ROW, F.monotonically_increasing_id()), label)


def as_batches(name: str, schema: str, df: DataFrame, work: Callable) -> DataFrame:
    """`mapInArrow` under a name that shows in Python profiles."""
    work.__name__ = name
    return df.mapInArrow(work, schema)


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """A public vocabulary file: in `folder`, or where the installed package keeps it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


#: The most bytes of one text that are held as separate words at a time.
RUN_BYTES = 1 << 22

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_runs(data: bytes, shape: Callable[[bytes], bytes], overlap: int = 0, size: int = RUN_BYTES) -> Iterator[list[bytes]]:
    """The words of `shape(data)` in runs; each run after the first begins with the last `overlap` words before it.

    `shape` must leave white space where it is.
    """
    start, carried = 0, []
    while start < len(data) or not start:
        end = start + size
        found = _BLANK.search(data, end) if end < len(data) else None
        end = found.start() if found else len(data)
        words = carried + shape(data[start:end]).split()
        yield words
        carried, start = words[max(0, len(words) - overlap) :] if overlap else [], max(end, 1)


def byte_texts(batch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column of an Arrow batch, null as empty."""
    import pyarrow as pa

    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def fold_of(key: Column) -> Column:
    """crc32 of the key as text, modulo 5; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5
