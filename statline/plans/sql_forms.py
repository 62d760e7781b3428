"""The player view, search, team summary and top list as Spark SQL.

Tables go in as DataFrames, values as named parameters; no value is ever spliced into the text.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame

from statline.operators.aggregates import Measure, Rate
from statline.plans import metrics


def _round2_sql(value: str) -> str:
    return f"SIGN({value}) * ROUND(ABS({value}) * 100, 0) / 100"


def _ratio_sql(measure: Measure) -> str:
    if isinstance(measure, Rate):
        part, whole, unit = f"SUM({measure.source})", f"SUM({measure.exposure})", f" * {measure.unit}"
    else:
        part, whole, unit = f"SUM({measure.part})", " + ".join(f"SUM({c})" for c in measure.whole), ""
    return _round2_sql(f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE){unit} END")


def player_view(players: DataFrame, teams: DataFrame, stats: DataFrame) -> DataFrame:
    sums = ",\n".join(f"SUM({c}) AS {c}" for c in metrics.TOTALS)
    derived = ",\n".join(f"{_ratio_sql(m)} AS {name}" for name, m in metrics.DERIVED.items())
    season = ", ".join(f"s.{c}" for c in (*metrics.TOTALS, *metrics.DERIVED))
    query = f"""
        WITH season AS (
            SELECT player_id, {sums}, {derived}
            FROM {{stats}}
            GROUP BY player_id
        )
        SELECT p.*, t.name AS team_name, {season}
        FROM {{players}} p
        LEFT JOIN {{teams}} t ON p.team_id = t.team_id
        LEFT JOIN season s ON p.player_id = s.player_id
    """
    return players.sparkSession.sql(query, players=players, teams=teams, stats=stats)


def search_players(view: DataFrame, bounds: dict[str, tuple[Any, Any]], position: str | None) -> DataFrame:
    conditions, values = [], {}
    for column, (low, high) in bounds.items():
        for sign, end, value in ((">=", "min", low), ("<=", "max", high)):
            if value is not None:
                conditions.append(f"{column} {sign} :{column}_{end}")
                values[f"{column}_{end}"] = value
    if position is not None:
        conditions.append("position = :position")
        values["position"] = position
    where = " AND ".join(conditions) or "TRUE"
    query = f"SELECT * FROM {{view}} WHERE {where} ORDER BY player_id"
    return view.sparkSession.sql(query, args=values, view=view)


def team_summary(view: DataFrame, teams: DataFrame, team_id: str | None) -> DataFrame:
    columns = []
    for c in metrics.SUMMARY_ORDER:
        if c in metrics.SUMMARY_MEANS:
            mean = f"CAST(SUM(CAST(a.{c} AS DECIMAL(18, 2))) AS DOUBLE) / NULLIF(COUNT(a.{c}), 0)"
            columns.append(f"{_round2_sql(mean)} AS avg_{c}")
        elif c in metrics.SUMMARY_SUMS:
            columns.append(f"{_round2_sql(f'CAST(SUM(a.{c}) AS DOUBLE)')} AS total_{c}")
        else:
            columns.append(f"SUM(a.{c}) AS total_{c}")
    where, values = ("WHERE a.team_id = :team_id", {"team_id": team_id}) if team_id is not None else ("", None)
    query = f"""
        WITH summed AS (
            SELECT a.team_id, {", ".join(columns)} FROM {{view}} a {where} GROUP BY a.team_id
        )
        SELECT t.league, t.name AS team_name, s.* EXCEPT (team_id)
        FROM summed s
        INNER JOIN {{teams}} t ON s.team_id = t.team_id
        ORDER BY t.name NULLS LAST
    """
    return view.sparkSession.sql(query, args=values, view=view, teams=teams)


def team_top(view: DataFrame, teams: DataFrame, team_id: str | None, n: int) -> DataFrame:
    values: dict[str, Any] = {"n": n}
    where = ""
    if team_id is not None:
        where, values["team_id"] = "AND r.team_id = :team_id", team_id
    listed = ", ".join(f"r.{c}" for c in metrics.TOP_COLUMNS)
    query = f"""
        WITH ranked AS (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY team_id ORDER BY goal_contribution DESC NULLS LAST, player_id
            ) AS ranking
            FROM {{view}}
        )
        SELECT t.league, r.team_name, r.name AS player_name, {listed}
        FROM ranked r
        LEFT JOIN {{teams}} t ON r.team_id = t.team_id
        WHERE r.ranking <= :n {where}
        ORDER BY r.team_name NULLS LAST, r.goal_contribution DESC NULLS LAST, r.player_id
    """
    return view.sparkSession.sql(query, args=values, view=view, teams=teams)
