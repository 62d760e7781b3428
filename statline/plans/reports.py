"""Player profiles, team reports and the run from raw files to reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from statline.plans.clean import clean_all
from statline.plans.marts import player_view, search_players, team_summary, team_top
from statline.plans.quality import check_all, quality_report
from statline.schemas import DATASETS
from statline.session import stored_in, work_dir
from statline.sources.landing import load_from_landing
from statline.sources.raw import confirm, ingest_raw
from statline.sources.reports import write_report
from statline.sources.warehouse import Warehouse

VIEW_TABLE = "agg_player_stats"


@dataclass(frozen=True)
class Profile:
    """A named search and the columns it reports."""

    columns: tuple[str, ...]
    limits: dict[str, Any] = field(default_factory=dict)
    position: str | None = None


# The three scouting profiles.
PROFILES = {
    "effective_scorers": Profile(
        ("name", "team_name", "age", "position", "minutes_played", "goals", "g_xg"),
        {"goals_min": 5, "g_xg_min": 2},
    ),
    "defensive_midfielders": Profile(
        ("name", "team_name", "age", "minutes_played", "pass_accuracy", "interceptions_90", "duel_win_rate"),
        {"pass_accuracy_min": 0.75, "interceptions_90_min": 3, "duel_win_rate_min": 0.5},
        "Midfielder",
    ),
    "creative_attackers": Profile(
        ("name", "team_name", "age", "minutes_played", "key_passes_90", "goal_contribution_90"),
        {"key_passes_90_min": 2, "goal_contribution_90_min": 0.5},
    ),
}


def profile(view: DataFrame, name: str, form: str = "dataframe") -> DataFrame:
    wanted = PROFILES[name]
    return search_players(view, wanted.position, form, **wanted.limits).select(*wanted.columns)


def write_player_reports(view: DataFrame, folder: str, form: str = "dataframe") -> dict[str, str]:
    """Write every profile; gives the path of each."""
    return {name: write_report(profile(view, name, form), folder, name) for name in PROFILES}


def write_team_reports(view: DataFrame, teams: DataFrame, folder: str, team_id: str | None = None,
                       form: str = "dataframe") -> dict[str, str]:
    """Write the summary and the top list of all teams or one."""
    which = team_id or "all"
    reports = {
        f"team_summary_{which}": team_summary(view, teams, team_id, form),
        f"team_top3_{which}": team_top(view, teams, team_id, form=form),
    }
    return {name: write_report(df, folder, name) for name, df in reports.items()}


def store_player_view(warehouse: Warehouse, form: str = "dataframe") -> DataFrame:
    """Build the player view from the stored tables and replace the stored one."""
    tables = {n: warehouse.read(DATASETS[n].table) for n in ("players", "teams", "player_match_stats")}
    absent = [n for n, df in tables.items() if df is None]
    if absent:
        raise ValueError(f"tables not stored yet: {', '.join(absent)}")
    view = player_view(tables["players"], tables["teams"], tables["player_match_stats"], form)
    return warehouse.write(VIEW_TABLE, view)


def clean_and_save(spark: SparkSession, landing_dir: str, warehouse: Warehouse, as_of: dt.date | None = None,
                   day_first: bool = False) -> dict[str, DataFrame]:
    """Clean what has landed and upsert it, parents first.

    Each cleaned table is written to the shared work folder before its children are checked against it: nothing is
    computed twice, and a lost executor costs at most one table.
    """
    store = stored_in(spark, work_dir(spark, "cleaned"))
    cleaned = clean_all(load_from_landing(spark, landing_dir), as_of, day_first, store=store)
    saved = {name: warehouse.save(name, df) for name, df in cleaned.items()}
    return {name: table for name, table in saved.items() if table is not None}


def run(spark: SparkSession, raw_dir: str, landing_dir: str, warehouse_dir: str, report_dir: str, force: bool = False,
        as_of: dt.date | None = None, day_first: bool = False, form: str = "sql",
        team_ids: Sequence[str] = (), by: str = "day") -> list[str]:
    """Raw files to reports: ingest, check, clean, save, aggregate, report. Gives the paths of the reports.

    Team reports cover all teams, and each of ``team_ids`` on its own. ``by`` says how changed raw files are found, see
    :func:`statline.sources.ingest_raw`; files taken by manifest are remembered once their rows are saved.
    """
    warehouse = Warehouse(spark, warehouse_dir)
    ingest_raw(spark, raw_dir, landing_dir, warehouse, force, by=by, confirmed=False)
    found = quality_report(check_all(load_from_landing(spark, landing_dir)))
    paths = [write_report(found, report_dir, "validation_report")]
    clean_and_save(spark, landing_dir, warehouse, as_of, day_first)
    confirm(spark, landing_dir, warehouse)
    view = store_player_view(warehouse, form)
    teams = warehouse.read(DATASETS["teams"].table)
    paths += write_player_reports(view, report_dir, form).values()
    for team_id in (None, *team_ids):
        paths += write_team_reports(view, teams, report_dir, team_id, form).values()
    return paths
