"""Types of text columns from all their values.

Every value has a kind: whole number, other number, boolean or text. Kinds of a column merge upwards: whole and other
numbers to a number, anything else that differs to mixed. Counts and the least value per kind are all that
merging needs, so one aggregate over all columns at once finds them; a task sends a few rows per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.numbers import to_double, to_long
from martloom.sources.raw import read_text_table

WHOLE, FLOAT, BOOLEAN, TEXT, NULL, MIXED = "whole", "float", "boolean", "text", "null", "mixed"

#: What a column of each type is cast to.
CASTS = {WHOLE: to_long, FLOAT: to_double, BOOLEAN: lambda c: F.trim(c).try_cast("boolean")}

# Fixed value: the spellings of booleans.
_BOOLEAN = r"^\s*(True|TRUE|true|False|FALSE|false)\s*$"
# An integer wider than a long counts as another number.
_INTEGER = r"^\s*[+-]?\d+\s*$"


def kind_of(value: Column) -> Column:
    """The kind of one text value; NULL for NULL."""
    text = value.cast("string")
    integer = text.rlike(_INTEGER) & text.try_cast("bigint").isNotNull()
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(integer, WHOLE)
        .when(to_double(text).isNotNull(), FLOAT)
        .when(text.rlike(_BOOLEAN), BOOLEAN)
        .otherwise(TEXT)
    )


def column_types(table: DataFrame) -> DataFrame:
    """A row per column, in their order: position, name, type, n_values, n_nulls, n_whole, n_float, n_boolean, n_text,
    n_bad, bad_example.

    `type` is null without values; whole, float or boolean when all values are; text when none is a number or boolean;
    else mixed. Bad are the values of a mixed column that are not of its commonest sort, numbers taken
    together (of equals the first of number, boolean, text); the example is the least of them. An empty
    table gives its columns with type null.
    """
    names = table.columns
    cells = F.array(*[F.struct(F.lit(i).alias("position"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(names)])
    counted = (
        table.select(F.inline(cells))
        .groupBy("position", kind_of(F.col("value")).alias("kind"))
        .agg(F.count("*").alias("n"), F.min("value").alias("least"))
    )
    listed = table.sparkSession.createDataFrame(list(enumerate(names)), "position INT, name STRING")
    n = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)) for k in (WHOLE, FLOAT, BOOLEAN, TEXT)}
    least = {k: F.min(F.when(F.col("kind") == k, F.col("least"))) for k in (WHOLE, FLOAT, BOOLEAN, TEXT)}
    nulls = F.coalesce(F.sum(F.when(F.col("kind").isNull(), F.col("n"))), F.lit(0))
    merged = counted.groupBy("position").agg(
        *[n[k].alias(f"n_{k}") for k in n], *[least[k].alias(f"l_{k}") for k in least], nulls.alias("n_nulls")
    )
    count = lambda k: F.coalesce(F.col(f"n_{k}"), F.lit(0))
    numbers, values = count(WHOLE) + count(FLOAT), count(WHOLE) + count(FLOAT) + count(BOOLEAN) + count(TEXT)
    kind = (
        F.when(values == 0, NULL)
        .when(count(WHOLE) == values, WHOLE)
        .when(numbers == values, FLOAT)
        .when(count(BOOLEAN) == values, BOOLEAN)
        .when(count(TEXT) == values, TEXT)
        .otherwise(MIXED)
    )
    most = F.greatest(numbers, count(BOOLEAN), count(TEXT))
    of_number, of_boolean = numbers == most, count(BOOLEAN) == most
    others = (
        F.when(of_number, F.array("l_boolean", "l_text"))
        .when(of_boolean, F.array("l_whole", "l_float", "l_text"))
        .otherwise(F.array("l_whole", "l_float", "l_boolean"))
    )
    mixed = F.col("type") == MIXED
    described = F.broadcast(listed).join(merged, "position", "left").withColumn("type", kind)
    return described.select(
        "position", "name", "type", values.alias("n_values"), F.coalesce("n_nulls", F.lit(0)).alias("n_nulls"),
        *[count(k).alias(f"n_{k}") for k in n],
        F.when(mixed, values - most).otherwise(F.lit(0)).alias("n_bad"),
        F.when(mixed, F.array_min(F.filter(others, lambda x: x.isNotNull()))).alias("bad_example"),
    )


def as_types(table: DataFrame, types: dict[str, str]) -> DataFrame:
    """`table` with its columns cast to the types named; columns of other types, or not named, stay text."""
    cast = lambda c: CASTS.get(types.get(c), lambda x: x)(F.col(f"`{c}`")).alias(c)
    return table.select(*[cast(c) for c in table.columns])


def read_typed_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """A CSV with its columns typed from all their values, and the table of types; a mixed column stays text.

    What comes to the driver is one type per column.
    """
    text = read_text_table(spark, path, columns)
    types = column_types(text)
    found = {r["name"]: r["type"] for r in types.select("name", "type").collect()}
    return as_types(text, found), types
