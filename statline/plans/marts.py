"""Player view, player search, team summary and team top list as DataFrame plans.

:mod:`statline.plans.sql_forms` holds the same four as Spark SQL. ``form`` picks one: both give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statline.functions.numbers import exact_mean, round2
from statline.operators.aggregates import add_derived, totals
from statline.operators.keys import top_n_per_group
from statline.operators.links import lookup
from statline.operators.search import equals, range_filter
from statline.plans import sql_forms
from statline.plans.metrics import (
    DERIVED, SEARCHABLE, SUMMARY_MEANS, SUMMARY_ORDER, SUMMARY_SUMS, TOP, TOP_COLUMNS, TOTALS,
)

FORMS = ("dataframe", "sql")


def pick_form(form: str, dataframe: Callable[..., DataFrame], sql: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    if form not in FORMS:
        raise ValueError(f"unknown form {form!r}: use one of {', '.join(FORMS)}")
    return sql if form == "sql" else dataframe


def player_season(stats: DataFrame, group: Sequence[str] = ("player_id",)) -> DataFrame:
    """Season totals of each player with rates per 90 minutes and accuracy ratios."""
    return add_derived(totals(stats, group, TOTALS), DERIVED)


def _player_view(players: DataFrame, teams: DataFrame, stats: DataFrame) -> DataFrame:
    team_names = teams.select("team_id", F.col("name").alias("team_name"))
    view = lookup(lookup(players, team_names, "team_id"), player_season(stats), "player_id")
    return view.select(*players.columns, "team_name", *TOTALS, *DERIVED)


def player_view(players: DataFrame, teams: DataFrame, stats: DataFrame, form: str = "dataframe") -> DataFrame:
    """Every player with team name and season metrics; a player without matches keeps null metrics.

    Not sorted: :func:`search_players` and the reports sort their results, a stored view need not be.
    """
    return pick_form(form, _player_view, sql_forms.player_view)(players, teams, stats)


def search_bounds(limits: dict[str, Any]) -> dict[str, tuple[Any, Any]]:
    """Bounds of all searchable columns from ``<column>_min`` / ``<column>_max`` arguments.

    Every lower bound is 0 unless given, so players with a null or negative metric are left out; a lower bound of None
    opens it.
    """
    allowed = {f"{c}_{end}" for c in SEARCHABLE for end in ("min", "max")}
    unknown = sorted(set(limits) - allowed)
    if unknown:
        raise TypeError(f"unknown search limits: {', '.join(unknown)}")
    return {c: (limits.get(f"{c}_min", 0), limits.get(f"{c}_max")) for c in SEARCHABLE}


def search_players(view: DataFrame, position: str | None = None, form: str = "dataframe", **limits: Any) -> DataFrame:
    """Players within all limits, sorted by key: ``search_players(view, "Forward", goals_min=5, age_max=23)``."""
    def dataframe(view: DataFrame, bounds: dict[str, tuple[Any, Any]], position: str | None) -> DataFrame:
        return range_filter(view, bounds, {"position": position}).orderBy("player_id")

    return pick_form(form, dataframe, sql_forms.search_players)(view, search_bounds(limits), position)


def _team_summary(view: DataFrame, teams: DataFrame, team_id: str | None) -> DataFrame:
    for condition in equals({"team_id": team_id}):
        view = view.filter(condition)
    aggregates = []
    for c in SUMMARY_ORDER:
        if c in SUMMARY_MEANS:
            aggregates.append(round2(exact_mean(F.col(c))).alias(f"avg_{c}"))
        elif c in SUMMARY_SUMS:
            aggregates.append(round2(F.sum(c).cast("double")).alias(f"total_{c}"))
        else:
            aggregates.append(F.sum(c).alias(f"total_{c}"))
    # Teams have a unique key, so grouping first gives the same sums and leaves one row per team to join.
    grouped = view.groupBy("team_id").agg(*aggregates)
    named = teams.select("team_id", "league", F.col("name").alias("team_name"))
    summary = lookup(grouped, named, "team_id", "inner").orderBy(F.asc_nulls_last("team_name"))
    return summary.select("league", "team_name", *grouped.columns[1:])


def team_summary(view: DataFrame, teams: DataFrame, team_id: str | None = None, form: str = "dataframe") -> DataFrame:
    """Summed and averaged player metrics of every team, or of one."""
    return pick_form(form, _team_summary, sql_forms.team_summary)(view, teams, team_id)


def _team_top(view: DataFrame, teams: DataFrame, team_id: str | None, n: int) -> DataFrame:
    for condition in equals({"team_id": team_id}):
        view = view.filter(condition)
    order = [F.desc_nulls_last("goal_contribution"), F.asc("player_id")]
    best = top_n_per_group(view, ["team_id"], order, n)
    leagues = teams.select("team_id", "league")
    columns = ["league", "team_name", F.col("name").alias("player_name"), *TOP_COLUMNS]
    # Leagues are looked up for the few rows left.
    listed = lookup(best, leagues, "team_id").orderBy(F.asc_nulls_last("team_name"), *order)
    return listed.select(*columns)


def team_top(view: DataFrame, teams: DataFrame, team_id: str | None = None, n: int = TOP,
             form: str = "dataframe") -> DataFrame:
    """The ``n`` players with most goal contributions of every team, or of one; ties go to the lower player key."""
    return pick_form(form, _team_top, sql_forms.team_top)(view, teams, team_id, n)
