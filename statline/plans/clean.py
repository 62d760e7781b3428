"""Cleaning of the five datasets: normalise, drop orphans, keep the last copy, derive.

Rows carry their arrival position in ``_seq``; ``order`` names other columns where a table has none.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statline.functions.dates import age_at, normalize_date
from statline.functions.numbers import whole_number
from statline.functions.text import normalize_position
from statline.operators.keys import keep_last, keep_last_of_repeated
from statline.operators.links import drop_orphans, keep_matching
from statline.schemas import DATASETS, LONG, SEQ

Order = Sequence[str]
Parents = Mapping[str, tuple[DataFrame, str]]
Store = Callable[[str, DataFrame], DataFrame]


def _link(dataset: str, df: DataFrame, source: DataFrame, parents: Parents, store: Store | None) -> DataFrame:
    """Rows with all parents; a parent of None is taken as checked before. With a place to store the missing keys they are
    found first, see ``drop_orphans``."""
    parents = {column: parent for column, parent in parents.items() if parent[0] is not None}
    if store is None or not parents:
        return keep_matching(df, parents, unique=True)
    return drop_orphans(df, parents, source, lambda column, keys: store(f"{dataset}_without_{column}", keys))


def typed(df: DataFrame, dataset: str) -> DataFrame:
    """Cast columns that still hold text to their declared type; a value that is none becomes null."""
    casts = {}
    for f in df.schema.fields:
        declared = DATASETS[dataset].raw.get(f.name)
        if declared is None or declared == f.dataType or isinstance(declared, T.StringType):
            continue
        if declared == LONG:
            casts[f.name] = whole_number(F.col(f.name), f.dataType)
        elif isinstance(f.dataType, T.StringType):
            casts[f.name] = F.col(f.name).try_cast(declared)
    return df.withColumns(casts) if casts else df


def clean_teams(teams: DataFrame, order: Order = (SEQ,)) -> DataFrame:
    return keep_last(teams, ["team_id"], order)


def clean_players(players: DataFrame, teams: DataFrame | None, as_of: dt.date | Column | None = None, day_first: bool = False,
                  order: Order = (SEQ,), store: Store | None = None) -> DataFrame:
    """Players of existing teams with grouped positions, real dates and the age on ``as_of`` (default: today)."""
    normalised = typed(players, "players").withColumns({
        "position": normalize_position(F.col("position")),
        "date_of_birth": normalize_date(F.col("date_of_birth"), day_first),
        "contract_until": normalize_date(F.col("contract_until"), day_first),
    })
    linked = _link("players", normalised, players, {"team_id": (teams, "team_id")}, store)
    today = F.current_date() if as_of is None else F.lit(as_of)
    return keep_last(linked, ["player_id"], order).withColumn("age", age_at(F.col("date_of_birth"), today))


def clean_matches(matches: DataFrame, day_first: bool = False, order: Order = (SEQ,)) -> DataFrame:
    dated = typed(matches, "matches").withColumn("match_date", normalize_date(F.col("match_date"), day_first))
    return keep_last(dated, ["match_id"], order)


def without_impossible_xg(stats: DataFrame) -> DataFrame:
    """Null the expected goals that are negative or above the number of shots."""
    xg = F.col("xg")
    return stats.withColumn("xg", F.when((xg < 0) | (xg > F.col("shots")), None).otherwise(xg))


def clean_player_match_stats(stats: DataFrame, players: DataFrame | None, matches: DataFrame | None, order: Order = (SEQ,),
                             store: Store | None = None) -> DataFrame:
    """Last line of each player and match, both known, with goal contribution and goals above expectation.

    Copies share both foreign keys, so keeping the last line first and dropping orphans second gives the same rows as
    the other way round. It spreads the rows over both keys, so a match or player with most of the rows is no hot spot,
    and it leaves fewer rows to join. With a place to store keys, those that come twice and those without a parent are
    found from the key columns alone, so whole rows need not be shuffled.
    """
    key, rows = ["player_id", "match_id"], typed(stats, "player_match_stats")
    if store is None:
        latest = keep_last(rows, key, order)
    else:
        latest = keep_last_of_repeated(rows, key, order, stats, lambda keys: store("player_match_stats_repeated", keys))
    parents = {"player_id": (players, "player_id"), "match_id": (matches, "match_id")}
    linked = _link("player_match_stats", latest, stats, parents, store)
    return without_impossible_xg(linked).withColumns({
        "goal_contribution": F.col("goals") + F.col("assists"),
        "g_xg": F.col("goals") - F.col("xg"),
    })


def clean_match_events(events: DataFrame, matches: DataFrame | None, teams: DataFrame | None, players: DataFrame | None,
                       order: Order = (SEQ,), store: Store | None = None) -> DataFrame:
    """Events of known matches, teams and players, last copy of each.

    Copies of an event may point to different parents, so orphans go first here.
    """
    parents = {"team_id": (teams, "team_id"), "match_id": (matches, "match_id"), "player_id": (players, "player_id")}
    linked = _link("match_events", typed(events, "match_events"), events, parents, store)
    return keep_last(linked, ["event_id"], order)


def clean_steps(as_of: dt.date | None = None, day_first: bool = False, order: Order = (SEQ,),
                store: Store | None = None) -> dict[str, Callable[..., DataFrame]]:
    """The cleaning of each dataset, parents first: a function of its rows and of its parents as they are declared."""
    return {
        "teams": lambda df: clean_teams(df, order),
        "players": lambda df, teams: clean_players(df, teams, as_of, day_first, order, store),
        "matches": lambda df: clean_matches(df, day_first, order),
        "player_match_stats": lambda df, players, matches: clean_player_match_stats(df, players, matches, order, store),
        "match_events": lambda df, matches, teams, players: clean_match_events(df, matches, teams, players, order, store),
    }


def clean_all(datasets: Mapping[str, DataFrame], as_of: dt.date | None = None, day_first: bool = False,
              order: Order = (SEQ,), store: Store | None = None, keys: Store | None = None) -> dict[str, DataFrame]:
    """Clean what is there, parents first; a child without its parents is left out.

    Children are checked against the *cleaned* parents. ``store`` writes a table and gives it back as stored, so that
    parents are not computed again for each child. ``keys`` stores only the keys that are missing or repeated, see
    ``drop_orphans`` and ``keep_last_of_repeated``; without either everything stays one plan.
    """
    steps = clean_steps(as_of, day_first, order, store or keys)
    cleaned: dict[str, DataFrame] = {}
    for name, step in steps.items():
        parents = list(DATASETS[name].references.values())
        if name not in datasets or any(p not in cleaned for p in parents):
            continue
        result = step(datasets[name], *[cleaned[p] for p in parents])
        cleaned[name] = store(name, result) if store else result
    return cleaned
