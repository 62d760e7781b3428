"""Sums and means of doubles that no order of the rows changes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every double is a whole number of units of 2 ** -1074. Blocks lie 22 bits apart; a value goes whole to the block that ends
# below its last bit, as four digits of 22 bits, the last of which has the sign. Sums of digits are plain bigints: 2 ** 40
# rows of a group are not too many.
UNIT, STEP, DIGITS = 1074, 22, 4
_BASE = 1 << STEP


def _digits(value: Column) -> tuple[Column, list[Column]]:
    """``(block, digits)`` with ``value = sum(digits[i] * 2 ** (STEP * (block + i) - UNIT))`` exactly.

    The logarithm may be off by one in its whole part, so two bits more than the 52 behind the first are left below it.
    """
    lowest = F.floor((F.log2(F.abs(value)) + (UNIT - 54)) / STEP)
    block = F.when(value == 0, 0).when(value.isNotNull(), F.greatest(F.lit(0), lowest)).cast("int")
    # Powers of two, taken half and half, as 2 ** 1074 is no double; neither product loses a bit.
    half = F.pow(F.lit(2.0), UNIT // 2 - STEP // 2 * block)
    whole = value * half * half
    high = F.floor(whole / 2.0 ** (2 * STEP))
    low = (whole - high * 2.0 ** (2 * STEP)).cast("bigint")
    return block, [low.bitwiseAND(_BASE - 1), F.shiftright(low, STEP), high.bitwiseAND(_BASE - 1), F.shiftright(high, STEP)]


def _carried(sums: Column, sign: int) -> Column:
    """Struct of ``carry`` (-1 where the sum is negative) and ``digits``, each below 2 ** STEP, from a map of blocks to sums of
    digits; the first digit belongs to the least block."""
    first, last = F.array_min(F.map_keys(sums)), F.array_max(F.map_keys(sums))

    def at(k: Column) -> Column:
        found = [F.coalesce(F.try_element_at(sums, k - i)[f"d{i}"], F.lit(0).cast("bigint")) for i in range(DIGITS)]
        return reduce(Column.__add__, found) * sign

    def step(done: Column, k: Column) -> Column:
        here = done["carry"] + at(k)
        digit = here.bitwiseAND(_BASE - 1)
        return F.struct(F.shiftright(here, STEP).alias("carry"), F.concat(done["digits"], F.array(digit)).alias("digits"))

    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits"))
    return F.aggregate(F.sequence(first, last + DIGITS + 2), start, step)


def _nearest(digits: Column, first: Column) -> Column:
    """The double nearest to a number of digits, ties to even: 60 bits from the first that is set, and whether any lower bit is
    set in the last of them, become a double, which the engine rounds once."""
    top = F.array_max(F.transform(digits, lambda d, i: F.when(d != 0, i)))

    def digit(below: int) -> Column:
        return F.when(top >= below, F.get(digits, top - below)).otherwise(0).cast("bigint")

    pair = digit(0) * _BASE + digit(1)
    rest = digit(2) * _BASE + digit(3)
    up = 60 - F.length(F.bin(pair))
    down = 2 * STEP - up
    kept = F.call_function("shiftleft", pair, up).bitwiseOR(F.call_function("shiftright", rest, down))
    lost = (rest != F.call_function("shiftleft", F.call_function("shiftright", rest, down), down)) | F.exists(
        F.slice(digits, 1, F.greatest(top - 3, F.lit(0))), lambda d: d != 0)
    bits = kept.bitwiseOR(lost.cast("bigint")).cast("double")
    power = STEP * (first + top - 1) - up - UNIT
    half = F.floor(power / 2)
    return F.when(top.isNull(), 0.0).otherwise(bits * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half))


def exact_totals(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per group ``sum_<c>``, ``mean_<c>`` and ``count_<c>`` of every column, the same under any order and partitioning.

    A sum is the double nearest to the true sum, as ``math.fsum`` gives it, whatever cancels on the way; the mean is that sum by
    the count. Nulls are not counted; a group without values has null sums and means. Infinities and NaN add up as they
    do in doubles. Without rows there are no groups; with an empty ``group`` all rows are one. A null is a key like any other.

    Values are summed by block before the shuffle, so at most 95 rows a group, column and task move, and a group that holds
    most of the rows is no hot spot.
    """
    keys = [F.col(f"`{g}`").alias(f"_key{i}") for i, g in enumerate(group)]
    names, numbers = [f"_key{i}" for i in range(len(group))], [str(i) for i in range(len(columns))]
    wide = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(i) for i, c in zip(numbers, columns)])
    value = F.col("value")
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    cells = wide.unpivot(names, numbers, "column", "value").select(
        *names, F.col("column").cast("int").alias("column"), F.when(finite, value).alias("value"), F.when(~finite, value).alias("odd"),
        F.when(value.isNotNull(), 1).otherwise(0).alias("one"))
    block, digits = _digits(value)
    cells = cells.select(*names, "column", "odd", "one", block.alias("block"), *[d.alias(f"d{i}") for i, d in enumerate(digits)])
    sums_of = [f"d{i}" for i in range(DIGITS)]
    blocks = cells.groupBy(*names, "column", "block").agg(*[F.sum(d).alias(d) for d in sums_of], F.sum("odd").alias("odd"),
                                                          F.sum("one").alias("one"))
    part = F.struct(F.col("block"), F.struct(*sums_of))
    sums = blocks.groupBy(*names, "column").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("block").isNotNull(), part))).alias("parts"), F.sum("odd").alias("odd"),
        F.sum("one").alias("count"))
    first = F.array_min(F.map_keys("parts"))
    some = F.size("parts") > 0
    up, down = (F.when(some, _carried(F.col("parts"), sign)) for sign in (1, -1))
    sums = sums.select(*names, "column", "odd", "count", first.alias("first"), up.alias("up"), down.alias("down"))
    total = F.when(F.col("up.carry") < 0, -_nearest(F.col("down.digits"), F.col("first"))).otherwise(
        _nearest(F.col("up.digits"), F.col("first")))
    sums = sums.withColumn("sum", F.when(F.col("count") > 0, F.coalesce("odd", total)))

    def of(i: int, name: str) -> Column:
        return F.max(F.when(F.col("column") == i, F.col(name)))

    out = [[of(i, "sum").alias(f"sum_{c}"), (of(i, "sum") / F.nullif(of(i, "count"), F.lit(0))).alias(f"mean_{c}"),
            of(i, "count").alias(f"count_{c}")] for i, c in enumerate(columns)]
    result = sums.groupBy(*names).agg(*reduce(list.__add__, out))
    return result.select(*[F.col(f"_key{i}").alias(g) for i, g in enumerate(group)],
                         *[F.col(f"`{kind}_{c}`") for c in columns for kind in ("sum", "mean", "count")])
