import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statline.functions import (
    age_at, composite_key, exact_mean, is_ambiguous_date, is_checked_date, json_rows, normalize_date, normalize_position,
    per_unit, ratio, round2, whole_number,
)


def values(spark, inputs, dtype, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {dtype}")
    return [r[0] for r in rows.select(expression(F.col("v")).alias("x"), "i").orderBy("i").select("x").collect()]


@pytest.mark.parametrize("label,group", [
    ("GK", "Goalkeeper"), ("Goalkeeper", "Goalkeeper"), ("cb", "Defender"), ("Centre-Back", "Defender"),
    ("DEFENDER", "Defender"), ("cm", "Midfielder"), ("Central Midfielder", "Midfielder"), ("midfielder", "Midfielder"),
    ("ST", "Forward"), ("Striker", "Forward"), ("forward", "Forward"),
    (None, "Unknown"), ("", "Unknown"), (" gk", "Unknown"), ("winger", "Unknown"), ("   ", "Unknown"),
])
def test_position(spark, label, group):
    assert values(spark, [label], "string", normalize_position) == [group]


def test_dates_in_mixed_layouts(spark):
    texts = ["2023-04-09", " 2023/4/9 ", "25/12/2023", "12/25/2023", "08/10/2023", "", None, "soon", "2023-02-30",
             "2024-02-29", "31/04/2023"]
    day = dt.date
    expected = [day(2023, 4, 9), day(2023, 4, 9), day(2023, 12, 25), day(2023, 12, 25), day(2023, 8, 10), None, None,
                None, None, day(2024, 2, 29), None]
    assert values(spark, texts, "string", normalize_date) == expected
    expected[4] = day(2023, 10, 8)
    assert values(spark, texts, "string", lambda c: normalize_date(c, day_first=True)) == expected


def test_dates_with_other_separators_and_times(spark):
    texts = ["25-12-2023", "25.12.2023", "2023.12.25", "2023-12-25T10:30:00", "25/12/2023 10:30", "2023-12-25 late",
             "2023-12/25", "12023-12-25", "25/12/23"]
    day = dt.date(2023, 12, 25)
    assert values(spark, texts, "string", normalize_date) == [day] * 5 + [None] * 4


def random_dates(draw, n):
    for _ in range(n):
        y, m, d = draw.randint(1900, 2100), draw.randint(0, 15), draw.randint(0, 33)
        order = draw.choice([(f"{y}", f"{m:02}", f"{d:02}"), (f"{d:02}", f"{m:02}", f"{y}"), (f"{m}", f"{d}", f"{y}")])
        yield draw.choice("-/.").join(order)


def test_dates_read_as_a_general_parser_reads_them(spark):
    parser = pytest.importorskip("dateutil.parser")
    texts = list(random_dates(random.Random(3), 3000))

    def read(text):
        try:
            return parser.parse(text).date()
        except ValueError:
            return None

    found = values(spark, texts, "string", normalize_date)
    assert [t for t, a in zip(texts, found) if a != read(t)] == []


def test_checked_dates_are_those_of_strptime(spark):
    texts = list(random_dates(random.Random(4), 3000)) + ["", None, "2023-1-5", "5/1/2023", "2023-01-05 ", "x"]

    def fits(text):
        for layout in ("%Y-%m-%d", "%d/%m/%Y"):
            try:
                return text is not None and bool(dt.datetime.strptime(text, layout))
            except ValueError:
                pass
        return False

    found = values(spark, texts, "string", is_checked_date)
    assert [t for t, a in zip(texts, found) if a != fits(t)] == []


def test_date_checks(spark):
    texts = ["2023-04-09", "25/12/2023", "12/25/2023", "2023/04/09", None]
    assert values(spark, texts, "string", is_checked_date) == [True, True, False, False, False]
    texts = ["08/10/2023", "10/10/2023", "25/12/2023", "2023-08-10", None]
    assert values(spark, texts, "string", is_ambiguous_date) == [True, False, False, False, False]


def test_age_turns_on_the_birthday(spark):
    day = dt.date
    born = [day(1990, 1, 1), day(2000, 12, 31), day(2000, 6, 15), day(2000, 6, 16), day(2004, 2, 29), None]
    assert values(spark, born, "date", lambda c: age_at(c, F.lit(day(2024, 6, 15)))) == [34, 23, 24, 23, 20, None]
    assert values(spark, [day(2000, 2, 29)], "date", lambda c: age_at(c, F.lit(day(2023, 2, 28)))) == [22]


def test_round2_is_binary(spark):
    draw = random.Random(7)
    numbers = [1.005, 0.285, 2.675, -1.005, 0.125, -0.125, 0.0, 63.5, -0.004] + [
        draw.randint(0, 400) / draw.randint(1, 400) * draw.choice([1, -1, 90]) for _ in range(3000)]

    def expected(x):
        scaled = abs(x) * 100
        below = math.floor(scaled)
        return math.copysign(below + (scaled - below >= 0.5), x) / 100

    assert values(spark, numbers, "double", round2) == [expected(x) for x in numbers]


def test_guarded_division(spark):
    df = spark.createDataFrame([(3, 4), (3, 0), (3, None), (None, 4), (3, -1)], "a bigint, b bigint")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.75, None, None, None, None]
    assert [r[0] for r in df.select(per_unit(F.col("a"), F.col("b"), 90)).collect()] == [67.5, None, None, None, None]


def test_exact_mean(spark):
    df = spark.createDataFrame([(0.63,), (0.64,), (None,)], "v double")
    assert df.agg(exact_mean(F.col("v"))).first()[0] == 0.635
    assert df.filter("v is null").agg(exact_mean(F.col("v"))).first()[0] is None


def test_whole_numbers(spark):
    texts = ["3", "3.0", "1.5", "x", None, "-4", "9007199254740993", " 7 "]
    expected = [3, 3, None, None, None, -4, 9007199254740993, 7]
    assert values(spark, texts, "string", lambda c: whole_number(c, T.StringType())) == expected
    assert values(spark, [2.0, 2.5, None], "double", lambda c: whole_number(c, T.DoubleType())) == [2, None, None]
    assert values(spark, [2, None], "int", lambda c: whole_number(c, T.IntegerType())) == [2, None]


def test_composite_key_is_null_with_any_part(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(composite_key(F.col("x"), F.col("y"))).collect()] == ["a-b", None]


def test_json_cells_to_rows(spark):
    df = spark.createDataFrame([("f", '[{"a":1,"b":"x"},{"a":2}]'), ("g", '{"a":3}'), ("h", "[]")], "file string, j string")
    record = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert sorted(map(tuple, json_rows(df, "j", record).collect()), key=str) == [("f", 1, "x"), ("f", 2, None), ("g", 3, None)]
    placed = json_rows(df, "j", record, position="n").select("file", "n", "a").collect()
    assert sorted(map(tuple, placed)) == [("f", 0, 1), ("f", 1, 2), ("g", 0, 3)]
