"""Dates read by what their column shows: a census of layouts settles whether days or months come first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A time of day and a zone may follow any layout; month names are English, whole or by three letters.
_TIME = r"(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?: ?(?:[Zz]|UTC|GMT|[+-]\d{2}:?\d{2}))?)?$"
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_NAME = (r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?"
         r"|nov(?:ember)?|dec(?:ember)?)")

# Layouts by name: the pattern, and the numbers of the parts that hold year, month and day.
LAYOUTS: Mapping[str, tuple[str, tuple[int, int, int]]] = {
    "year_first": (r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})" + _TIME, (1, 3, 4)),
    "compact": (r"^(\d{4})(\d{2})(\d{2})" + _TIME, (1, 2, 3)),
    "day_month_name": (r"(?i)^(\d{1,2})(?:st|nd|rd|th)?[ -]" + _NAME + r"\.?,?[ -](\d{4})" + _TIME, (3, 2, 1)),
    "month_name_day": (r"(?i)^" + _NAME + r"\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})" + _TIME, (3, 1, 2)),
}
YEAR_LAST = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})" + _TIME


def _part(text: Column, pattern: str, number: int) -> Column:
    return F.regexp_extract(text, pattern, number)


def _month(text: Column) -> Column:
    number = F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), F.lower(F.substring(text, 1, 3)))
    return F.when(number > 0, number.cast("string")).otherwise(text)


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, month, day).try_cast("date")


def date_as(text: Column, day_first: Column) -> Column:
    """Date of a text in any declared layout, null where it is none. With the year last, ``day_first`` says how it is read, and
    there is no second try. A time is left out; the date is that of the zone the text is written in."""
    text = F.trim(text)
    first, second, year = (_part(text, YEAR_LAST, i) for i in (1, 3, 4))
    out = F.when(text.rlike(YEAR_LAST), F.when(day_first, _date(year, second, first)).otherwise(_date(year, first, second)))
    for pattern, (y, m, d) in LAYOUTS.values():
        month = _part(text, pattern, m)
        out = out.when(text.rlike(pattern), _date(_part(text, pattern, y), _month(month), _part(text, pattern, d)))
    return out


def date_census(df: DataFrame, columns: Sequence[str], day_first: bool = False) -> DataFrame:
    """One row a column: ``column``, ``texts``, a count for every layout and for ``year_last``, ``unknown``, ``days_first``,
    ``months_first``, ``mixed`` and ``day_first``.

    ``days_first`` counts the texts with the year last that are dates only with the day first, ``months_first`` those that
    are dates only with the month first. Where just one of the two is above zero it settles the column. Where neither is,
    or both are (``mixed``), the parameter does. Nulls and blank texts are no texts. A table without rows gives zeros. One
    scan counts all columns, partly before the shuffle, so what moves is one row a task.
    """
    def counts(name: str) -> list[Column]:
        text = F.trim(F.col(f"`{name}`"))
        first, second, year = (_part(text, YEAR_LAST, i) for i in (1, 3, 4))
        days, months = _date(year, second, first).isNotNull(), _date(year, first, second).isNotNull()
        last, known = text.rlike(YEAR_LAST), {n: text.rlike(p) for n, (p, _) in LAYOUTS.items()}
        any_known = reduce(Column.__or__, known.values(), last)
        tests = {"texts": text != "", **known, "year_last": last, "unknown": (text != "") & ~any_known,
                 "days_first": last & days & ~months, "months_first": last & months & ~days}
        return [F.count_if(test).alias(kind) for kind, test in tests.items()]

    if not columns:
        raise ValueError("a census needs at least one column")
    counted = df.agg(*[F.struct(*counts(c)).alias(f"_census{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_census{i}").alias("n")) for i, c in enumerate(columns)])
    days, months = F.col("days_first") > 0, F.col("months_first") > 0
    settled = F.when(days & ~months, True).when(months & ~days, False).otherwise(F.lit(day_first))
    return counted.select(F.inline(rows)).select("column", "n.*").select(
        "*", (days & months).alias("mixed"), settled.alias("day_first"))


def read_dates(df: DataFrame, columns: Sequence[str], day_first: bool = False) -> DataFrame:
    """The rows with the named text columns as dates, each column read one way throughout, as :func:`date_census` settles it.

    Texts that are no date in that reading give null, also where the other reading would have given one: in a ``mixed`` column
    the census says how many there are. The census is one job; its one row a column is all that reaches the driver.
    """
    if not columns:
        return df
    way = {r["column"]: r["day_first"] for r in date_census(df, columns, day_first).collect()}
    parsed = {c: date_as(F.col(f"`{c}`"), F.lit(way[c])).cast(T.DateType()).alias(c) for c in columns}
    return df.select(*[parsed[c] if c in parsed else F.col(f"`{c}`") for c in df.columns])
