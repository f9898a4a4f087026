"""Sums and means of doubles that do not depend on the order of rows.

A double is a whole number of 53 bits times a power of two, so a sum of doubles can be kept exactly in whole
numbers. Values are put in bins of 32 exponents. In a bin a value is a whole number of units, cut into a low
part of 32 bits and a high part, and each part is summed as a decimal. That is an ordinary aggregate: it is
folded before the shuffle, and a group has at most 67 bins. The bins of a group are then carried into digits
of 32 bits, and the digits are rounded to a double once.

Shuffled rows, other partitions and repeated tasks therefore give the same bits, and the sum is the double
nearest to the true sum, also where values cancel. A bin holds up to 10^11 rows of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN = 32  # exponents in a bin and bits in a digit
_UNIT = 53  # a unit of bin b is 2^(32 b - 53): one bit of slack, as log2 may err near a power of two
_DIGIT = 1 << BIN
_CARRY_DIGITS = 5  # digits above the highest bin that a sum of 10^11 rows can reach


def _scaled(x: Column, power: Column) -> Column:
    """x * 2^power in two steps, as the power alone may lie beyond the doubles."""
    half = F.floor(power / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def _carried(parts: Column) -> Column:
    """The digits of the sum of `parts`, lowest first, and the carry above them: 0, or -1 for a negative sum."""
    zero = F.lit(0).cast("decimal(38,0)")
    base = F.lit(_DIGIT).cast("decimal(20,0)")

    def at(k: Column) -> Column:
        def add(total: Column, p: Column) -> Column:
            part = F.when(p["bin"] == k, p["low"]).when(p["bin"] == k - 1, p["high"]).otherwise(zero)
            return (total + part).cast("decimal(38,0)")

        return F.aggregate(parts, zero, add)

    def step(state: Column, k: Column) -> Column:
        whole = (at(k) + state["carry"]).cast("decimal(38,0)")
        digit = F.pmod(whole, base).cast("bigint")
        carry = ((whole - digit) / base).cast("decimal(38,0)")
        return F.struct(carry.alias("carry"), F.concat(state["digits"], F.array(digit)).alias("digits"))

    start = F.struct(zero.alias("carry"), F.expr("array()").cast("array<bigint>").alias("digits"))
    places = F.sequence(F.array_min(parts["bin"]), F.array_max(parts["bin"]) + _CARRY_DIGITS)
    return F.aggregate(places, start, step)


def _negated(digits: Column) -> Column:
    """The digits of minus a number whose carry is -1: all ones minus each digit, from the first that is not zero."""
    first = F.array_min(_places(digits))

    def turn(d: Column, i: Column) -> Column:
        return F.when(i < first, F.lit(0)).when(i == first, _DIGIT - d).otherwise(_DIGIT - 1 - d).cast("bigint")

    return F.transform(digits, turn)


def _places(digits: Column) -> Column:
    """The positions of the digits that are not zero."""
    return F.filter(F.transform(digits, lambda d, i: F.when(d != 0, i)), lambda i: i.isNotNull())


def _rounded(digits: Column, used: Column, lowest: Column) -> Column:
    """The double nearest to a number of base 2^32 digits, lowest first; `lowest` is the bin of the first.

    The 21 bits below the top digit's are read exactly into one double and the next 52 into another, whose last
    bit also tells whether anything follows. Both are exact, so adding them rounds once.
    """

    def number(top: Column) -> Column:
        def digit(below: int) -> Column:
            return F.coalesce(F.when(top >= below, F.get(digits, top - below)), F.lit(0))

        rest = (F.array_min(used) < top - 3) | (digit(3).bitwiseAND((1 << 23) - 1) != 0)
        high = F.shiftleft(digit(0), 21) + F.shiftright(digit(1), 11)
        low = F.shiftleft(digit(1).bitwiseAND((1 << 11) - 1), 41) + F.shiftleft(digit(2), 9) + F.shiftright(digit(3), 23)
        low = F.when(rest, low.bitwiseOR(F.lit(1))).otherwise(low)
        both = high.cast("double") * float(1 << 52) + low.cast("double")
        return F.coalesce(_scaled(both, (lowest + top) * BIN - _UNIT - 73), F.lit(0.0))

    return _named(F.array_max(used), number)


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where `value` is computed once however often it is used, also after filters are pushed down."""
    return F.get(F.transform(F.array(value), use), 0)


def _total(parts: Column) -> Column:
    """The double nearest to the sum of the parts of a group; a group in one bin is one decimal."""
    lowest = F.array_min(parts["bin"])
    only = F.get(parts, 0)
    units = (only["high"] * F.lit(_DIGIT).cast("decimal(10,0)") + only["low"]).cast("decimal(38,0)")

    def signed(carried: Column) -> Column:
        def rounded(digits: Column) -> Column:
            return _named(_places(digits), lambda used: _rounded(digits, used, lowest))

        negative = carried["carry"] < 0
        size = _named(F.when(negative, _negated(carried["digits"])).otherwise(carried["digits"]), rounded)
        return size * F.when(negative, F.lit(-1.0)).otherwise(F.lit(1.0))

    one = _scaled(units.cast("double"), only["bin"] * BIN - _UNIT)
    return F.when(F.size(parts) == 1, one).otherwise(_named(_carried(parts), signed))


def exact_group(
    rows: DataFrame,
    by: list[str],
    means: Mapping[str, str | Column] | None = None,
    sums: Mapping[str, str | Column] | None = None,
    wholes: Mapping[str, str | Column] | None = None,
) -> DataFrame:
    """One row per group of `by`: exact `means` and `sums` of doubles, and plain sums of `wholes` numbers.

    Each maps a result column to what is summed; all keep a null for a group without a value. A value that is not
    finite makes the sum what adding it makes it: infinite, or NaN. A mean is the exact sum, rounded, over
    the count. Without `by` there is one row, also for an empty table.
    """
    means, sums, wholes = dict(means or {}), dict(sums or {}), dict(wholes or {})
    exact = {**means, **sums}

    def column(c: str | Column) -> Column:
        return F.col(f"`{c}`") if isinstance(c, str) else c

    keys = [f"__key_{i}" for i in range(len(by))]
    entries = F.array(*[F.struct(F.lit(i).alias("slot"), column(c).cast("double").alias("x")) for i, c in enumerate(exact.values())])
    long = rows.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys)],
        *[column(c).alias(f"__whole_{i}") for i, c in enumerate(wholes.values())],
        F.explode(entries).alias("__entry"),
    )
    slot, x = F.col("__entry.slot"), F.col("__entry.x")
    finite = F.abs(x) < float("inf")
    # zero belongs to no bin, but a group of zeros has to be told from a group of nulls
    size = F.when(finite & (x != 0), F.floor(F.log2(F.abs(x)) / BIN)).when(finite, F.lit(0)).cast("int")
    units = _scaled(x, _UNIT - BIN * F.col("__bin"))
    high = F.floor(units / _DIGIT)
    binned = (
        long.withColumn("__slot", slot)
        .withColumn("__bin", size)
        .groupBy(*keys, "__slot", "__bin")
        .agg(
            F.sum(high.cast("decimal(28,0)")).alias("high"),
            F.sum((units - high * float(_DIGIT)).cast("bigint").cast("decimal(28,0)")).alias("low"),
            F.count(x).alias("n"),
            F.sum(F.when(~finite, x)).alias("special"),
            *[F.sum(F.when(slot == 0, F.col(f"__whole_{i}"))).alias(f"whole_{i}") for i in range(len(wholes))],
        )
    )
    part = F.struct(F.col("__bin").alias("bin"), "high", "low")

    def of(i: int, c: str | Column) -> Column:
        return F.when(F.col("__slot") == i, c if isinstance(c, Column) else F.col(c))

    gathered = binned.groupBy(*keys).agg(
        *[F.collect_list(of(i, F.when(F.col("__bin").isNotNull(), part))).alias(f"parts_{i}") for i in range(len(exact))],
        *[F.sum(of(i, "n")).alias(f"n_{i}") for i in range(len(exact))],
        *[F.sum(of(i, "special")).alias(f"special_{i}") for i in range(len(exact))],
        *[F.sum(f"whole_{i}").alias(f"whole_{i}") for i in range(len(wholes))],
    )
    results = []
    for i, name in enumerate(exact):
        total = F.coalesce(F.col(f"special_{i}"), _named(F.col(f"parts_{i}"), _total))
        total = F.when(F.col(f"n_{i}") > 0, total)
        results.append((F.try_divide(total, F.col(f"n_{i}")) if name in means else total).alias(name))
    return gathered.select(
        *[F.col(k).alias(c) for k, c in zip(keys, by)],
        *results,
        *[F.col(f"whole_{i}").alias(name) for i, name in enumerate(wholes)],
    )


def group_means(
    rows: DataFrame,
    by: list[str],
    means: Mapping[str, str],
    wholes: Mapping[str, str] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Means of doubles and sums of whole numbers per group; `exact` takes the sums of the means exactly.

    Plain averages are the cheaper choice where the last bits of a result do not matter.
    """
    if exact:
        return exact_group(rows, by, means=means, wholes=wholes)
    return rows.groupBy(*by).agg(
        *[F.avg(c).alias(name) for name, c in means.items()], *[F.sum(c).alias(name) for name, c in (wholes or {}).items()]
    )
