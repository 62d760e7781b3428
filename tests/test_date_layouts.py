"""Date layouts settled by a census of their column."""

import datetime as dt

import pytest

from statline.operators.date_layouts import date_census, read_dates


def _read(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.t for r in read_dates(df, ["t"], **options).orderBy("i").collect()]


@pytest.mark.parametrize("text, day", [
    ("2023-01-15T10:00:00Z", (2023, 1, 15)), ("2023-01-15 23:59:59.123+02:00", (2023, 1, 15)), ("20230115", (2023, 1, 15)),
    ("15 Jan 2023", (2023, 1, 15)), (" 3rd september, 2023 ", (2023, 9, 3)), ("January 15, 2023", (2023, 1, 15)),
    ("SEPT. 5 2023", (2023, 9, 5)), ("15-May-2023", (2023, 5, 15)), ("2023/1/5", (2023, 1, 5)), ("29.02.2024", (2024, 2, 29)),
    ("29 Feb 2023", None), ("20231301", None), ("2023-01/15", None), ("15 Janu 2023", None), ("202301150", None), ("", None),
    ("1.2.23", None), ("now", None), (None, None)])
def test_layouts(spark, text, day):
    assert _read(spark, [text]) == [day and dt.date(*day)]


def test_one_day_over_twelve_settles_a_column(spark):
    assert _read(spark, ["03/04/2023", "25/04/2023"]) == [dt.date(2023, 4, 3), dt.date(2023, 4, 25)]
    assert _read(spark, ["03/04/2023", "04/25/2023"], day_first=True) == [dt.date(2023, 3, 4), dt.date(2023, 4, 25)]
    assert _read(spark, ["03/04/2023"]) == [dt.date(2023, 3, 4)]
    assert _read(spark, ["03/04/2023"], day_first=True) == [dt.date(2023, 4, 3)]
    # Evidence both ways: the parameter decides, no text is read the other way.
    assert _read(spark, ["25/04/2023", "04/25/2023"]) == [None, dt.date(2023, 4, 25)]


def test_census(spark):
    df = spark.createDataFrame([("25/04/2023", "1/2/2023"), ("04/25/2023", "20230102"), ("5 May 2023", " "), ("x", None),
                                ("99/99/2023", "13/1/2023")], "`a.b` string, column string")
    rows = {r["column"]: r.asDict() for r in date_census(df, ["a.b", "column"]).collect()}
    assert rows["a.b"] == {"column": "a.b", "texts": 5, "year_first": 0, "compact": 0, "day_month_name": 1, "month_name_day": 0,
                           "year_last": 3, "unknown": 1, "days_first": 1, "months_first": 1, "mixed": True, "day_first": False}
    assert (rows["column"]["texts"], rows["column"]["compact"], rows["column"]["day_first"]) == (3, 1, True)
    empty = date_census(df.where("false"), ["column"], day_first=True).first()
    assert (empty.texts, empty.mixed, empty.day_first) == (0, False, True)
    assert read_dates(df, ["column"]).columns == ["a.b", "column"]
