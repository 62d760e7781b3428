"""Date column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A date a cleaner accepts, parted by dashes, slashes or dots, year first or last, a time of day allowed.
_DATE_TEXT = r"^(\d{4}([-/.])\d{1,2}\2\d{1,2}|\d{1,2}([-/.])\d{1,2}\3\d{4})([T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"

# The two layouts the quality rules accept, YYYY-MM-DD and DD/MM/YYYY.
_YEAR_FIRST, _DAY_FIRST = r"^\d{4}-\d{1,2}-\d{1,2}$", r"^\d{1,2}/\d{1,2}/\d{4}$"


def _date(year: Column, month: Column, day: Column) -> Column:
    """Date of three texts, null if there is none.

    A cast, not a format parser: the parser raises and catches an error for every text it cannot read, which costs far
    more than the reading.
    """
    return F.concat_ws("-", year, month, day).try_cast("date")


def _parts(text: Column) -> tuple[Column, Column, Column]:
    """The three numbers of a date text, null where the text is none."""
    day = F.translate(F.substring_index(F.substring_index(text, "T", 1), " ", 1), "/.", "--")
    parts = F.split(F.when(text.rlike(_DATE_TEXT), day), "-")
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2))


def normalize_date(value: Column, day_first: bool = False) -> Column:
    """Date from text in mixed layouts; unreadable text gives null.

    With the year last, the month is read first, or second where the first number cannot be a month. ``day_first`` turns
    the preference round.
    """
    first, second, third = _parts(F.trim(value))
    month_first, month_second = _date(third, first, second), _date(third, second, first)
    year_last = F.coalesce(month_second, month_first) if day_first else F.coalesce(month_first, month_second)
    return F.when(F.length(first) == 4, _date(first, second, third)).otherwise(year_last)


def is_ambiguous_date(value: Column) -> Column:
    """True where the year is last and the two readings give different dates."""
    first, second, third = _parts(F.trim(value))
    differ = _date(third, first, second) != _date(third, second, first)
    return F.coalesce(differ & (F.length(third) == 4), F.lit(False))


def is_checked_date(text: Column) -> Column:
    """True where the text is a date in one of the two layouts the quality rules accept."""
    parts = F.split(text, "[-/]")
    first, second, third = (F.get(parts, F.lit(i)) for i in range(3))
    year_first = text.rlike(_YEAR_FIRST) & _date(first, second, third).isNotNull()
    day_first = text.rlike(_DAY_FIRST) & _date(third, second, first).isNotNull()
    return F.coalesce(year_first | day_first, F.lit(False))


def age_at(born: Column, as_of: Column) -> Column:
    """Full years between two dates: the year turns on the birthday itself, 29 February counting as 1 March."""
    def day_of_year(day: Column) -> Column:
        return F.month(day) * 100 + F.dayofmonth(day)

    return F.year(as_of) - F.year(born) - (day_of_year(as_of) < day_of_year(born)).cast("int")
