"""Sums of doubles against math.fsum, under any order and partitioning."""

import math
import random

import pytest
from pyspark.sql import functions as F

from statline.operators.exact import exact_totals


def _sums(spark, rows, parts=1):
    df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
    return {r.g: (r.sum_v, r.mean_v, r.count_v) for r in exact_totals(df, ["g"], ["v"]).collect()}


@pytest.mark.parametrize("parts", [1, 7])
def test_sums_are_those_of_fsum(spark, parts):
    rng = random.Random(4)
    groups = {
        "plain": [rng.uniform(-1e5, 1e5) for _ in range(500)],
        "cancel": [1e16, 1.0, -1e16, 1e-9] * 50,
        "wide": [math.ldexp(rng.uniform(-1, 1), rng.randint(-1074, 1000)) for _ in range(2000)],
        "tiny": [5e-324, 5e-324, -1e-310, 2.2250738585072014e-308],
        "large": [1.7e308, -1.7e308, 1.7976931348623157e308, -1e292],
        "powers": [s * 2.0 ** e for e in range(-1074, 1020, 3) for s in (1, -0.75)],
        "below powers": [math.nextafter(2.0 ** e, 0) for e in range(-1000, 1000, 7)],
        "thousandths": [0.001, 0.002],
        "zeros": [0.0, -0.0],
    }
    got = _sums(spark, [(g, v) for g, values in groups.items() for v in values], parts)
    for g, values in groups.items():
        assert got[g] == (math.fsum(values), math.fsum(values) / len(values), len(values)), g


def test_nulls_and_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    got = _sums(spark, [("none", None), ("some", None), ("some", 1.5), (None, 2.0), ("up", inf), ("up", 1.0),
                        ("both", inf), ("both", -inf), ("nan", nan), ("nan", 1.0), ("past", 1.7e308), ("past", 1.7e308)])
    assert got["none"] == (None, None, 0) and got["some"] == (1.5, 1.5, 1) and got[None] == (2.0, 2.0, 1)
    assert got["up"][0] == inf and math.isnan(got["both"][0]) and math.isnan(got["nan"][0]) and got["past"][0] == inf


def test_several_columns_names_that_clash_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0.1, 3), (1, 0.2, None)], "column int, `sum` double, block int")
    row = exact_totals(df, ["column"], ["sum", "block"]).first()
    assert (row["column"], row["sum_sum"], row["mean_block"], row["count_block"]) == (1, 0.1 + 0.2, 3.0, 1)
    assert exact_totals(df.where("false"), ["column"], ["sum"]).count() == 0
    assert exact_totals(df, [], ["sum"]).first()["sum_sum"] == math.fsum([0.1, 0.2])


def test_a_hot_group_moves_few_rows(spark):
    df = spark.range(0, 20000, 1, 8).select(F.lit("hot").alias("g"), F.rand(3).alias("v"))
    values = [r.v for r in df.collect()]
    assert exact_totals(df, ["g"], ["v"]).first().sum_v == math.fsum(values)


def test_sums_stay_in_spark(spark):
    df = spark.createDataFrame([("a", 0.1)], "g string, v double")
    plan = exact_totals(df, ["g"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Generate" not in plan


@pytest.mark.parametrize("sign", [1, -1])
def test_ties_go_to_even_and_a_lower_bit_breaks_them(spark, sign):
    half = 2.0 ** -53
    groups = {"even": [1.0, half], "odd": [1.0 + 2 * half, half], "above": [1.0, half, 2.0 ** -1074], "below": [1.0, half, -(2.0 ** -1074)],
              "largest": [1.7976931348623157e308, 2.0 ** 969], "past it": [1.7976931348623157e308, 2.0 ** 970]}
    got = _sums(spark, [(g, sign * v) for g, values in groups.items() for v in values])
    assert [got[g][0] * sign for g in groups] == [1.0, 1.0 + 4 * half, 1.0 + 2 * half, 1.0, 1.7976931348623157e308, float("inf")]
