"""The quality rules of the five datasets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statline.functions.dates import is_checked_date
from statline.functions.numbers import whole_number
from statline.operators.rules import Rule, RuleSet
from statline.schemas import COUNT_STATS, DATASETS, LONG

# Cards one player can be shown in a match, seconds in a minute, the pitch in percent of its length.
YELLOW_CARDS, RED_CARDS, SECONDS, PITCH = (0, 2), (0, 1), (0, 59), (0, 100)

_LAYOUT_HINT = "expected YYYY-MM-DD or DD/MM/YYYY"


class _Columns:
    """Typed access to the columns of one table: numbers may still be text, and columns may be absent."""

    def __init__(self, df: DataFrame, dataset: str):
        self.types = {f.name: f.dataType for f in df.schema.fields}
        self.declared = DATASETS[dataset].raw

    def __contains__(self, name: str) -> bool:
        return name in self.types

    def value(self, name: str) -> Column:
        """The value as its declared type, null where it is not one; null too for an absent column."""
        declared = self.declared[name]
        if name not in self:
            return F.lit(None).cast(declared)
        actual = self.types[name]
        if declared == LONG:
            return whole_number(F.col(name), actual)
        if isinstance(actual, T.StringType) and not isinstance(declared, T.StringType):
            return F.col(name).try_cast(declared)
        return F.col(name).cast(declared)

    def mistyped(self, name: str) -> Rule | None:
        """Rule for a set value that is not of the declared type; None where the column's type rules it out."""
        declared, actual = self.declared[name], self.types.get(name)
        if actual is None or actual == declared or (declared == LONG and isinstance(actual, T.IntegralType)):
            return None
        if not isinstance(actual, T.StringType) and declared != LONG:
            return None
        wrong = F.col(name).isNotNull() & self.value(name).isNull()
        return Rule("type", name, wrong, F.concat(F.lit(f"not a {declared.simpleString()}: "), F.col(name).cast("string")))


def _required(columns: _Columns, names: Sequence[str]) -> list[Rule]:
    return [
        Rule("required", n, F.col(n).isNull() if n in columns else F.lit(True), F.lit("value is missing"))
        for n in names
    ]


def _typed(columns: _Columns, names: Sequence[str]) -> list[Rule]:
    return [rule for rule in map(columns.mistyped, names) if rule is not None]


def _ranged(columns: _Columns, name: str, low: float, high: float | None = None) -> Rule:
    """Value below ``low``, above ``high`` or not a number. Spark orders NaN above every number, hence the own test."""
    value = columns.value(name)
    outside = value < low if high is None else ~value.between(low, high)
    if isinstance(columns.declared[name], T.FractionalType):
        outside = outside | F.isnan(value)
    allowed = f"at least {low}" if high is None else f"between {low} and {high}"
    return Rule("range", name, outside, F.concat(F.lit(f"must be {allowed}: "), value.cast("string")))


def _dated(columns: _Columns, name: str) -> list[Rule]:
    if name not in columns:
        return []
    value = F.col(name).cast("string")
    bad = value.isNotNull() & ~is_checked_date(value)
    return [Rule("date_layout", name, bad, F.concat(F.lit(f"unreadable date, {_LAYOUT_HINT}: "), value))]


def _exceeds(columns: _Columns, name: str, part: str, whole: str) -> Rule:
    left, right = columns.value(part), columns.value(whole)
    message = F.concat(F.lit(f"{part} "), left.cast("string"), F.lit(f" is more than {whole} "), right.cast("string"))
    return Rule(name, part, left > right, message)


def _teams(c: _Columns) -> RuleSet:
    return RuleSet(tuple(_required(c, ("team_id", "name", "league", "stadium", "city"))))


def _players(c: _Columns) -> RuleSet:
    field = _required(c, ("player_id", "name", "team_id", "position"))
    field += _dated(c, "date_of_birth") + _dated(c, "contract_until")
    field += _typed(c, ("market_value",)) + [_ranged(c, "market_value", 0)]
    return RuleSet(tuple(field))


def _matches(c: _Columns) -> RuleSet:
    counts = ("home_score", "away_score", "attendance")
    field = _required(c, list(DATASETS["matches"].raw)) + _typed(c, counts)
    field += [_ranged(c, n, 0) for n in counts] + _dated(c, "match_date")
    return RuleSet(tuple(field))


def _player_match_stats(c: _Columns) -> RuleSet:
    capped = {"yellow_cards": YELLOW_CARDS, "red_cards": RED_CARDS}
    numbers = (*COUNT_STATS, "xg", "xa")
    field = _required(c, ("player_id", "match_id", *numbers)) + _typed(c, numbers)
    field += [_ranged(c, n, *capped.get(n, (0,))) for n in numbers]
    cross = (
        _exceeds(c, "shots_on_target", "shots_on_target", "shots"),
        _exceeds(c, "passes_completed", "passes_completed", "passes_attempted"),
        _exceeds(c, "xg_above_shots", "xg", "shots"),
    )
    return RuleSet(tuple(field), cross)


def _match_events(c: _Columns) -> RuleSet:
    starts = [n for n in ("x_start", "y_start") if n in c]
    ends = ("x_end", "y_end")
    texts = ("event_id", "match_id", "event_type", "player_id", "team_id", "outcome")
    field = _required(c, (*texts, "minute", "second", *starts)) + _typed(c, ("minute", "second", *starts, *ends))
    field += [_ranged(c, "minute", 0), _ranged(c, "second", *SECONDS)]
    field += [_ranged(c, n, *PITCH) for n in (*starts, *ends)]

    def needs(name: str, column: str, types: Sequence[str], missing: Column) -> Rule:
        message = F.concat(F.col("event_type"), F.lit(" "), F.col("event_id"), F.lit(f" has no {name}"))
        return Rule(name, column, F.col("event_type").isin(list(types)) & missing, message)

    cross = (
        needs("destination", "x_end", ("pass",), c.value("x_end").isNull() | c.value("y_end").isNull()),
        needs("pass_type", "pass_type", ("pass",), c.value("pass_type").isNull()),
        needs("recipient", "recipient_id", ("pass",), c.value("recipient_id").isNull()),
        needs("body_part", "body_part", ("pass", "shot"), c.value("body_part").isNull()),
    )
    return RuleSet(tuple(field), cross)


_BOOK: dict[str, Callable[[_Columns], RuleSet]] = {
    "teams": _teams,
    "players": _players,
    "matches": _matches,
    "player_match_stats": _player_match_stats,
    "match_events": _match_events,
}


def rules_for(dataset: str, df: DataFrame) -> RuleSet:
    """Rules of a dataset, fitted to the columns and types ``df`` has."""
    return _BOOK[dataset](_Columns(df, dataset))
