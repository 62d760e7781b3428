"""The five datasets of the star schema: declared once, used by readers, rules, cleaners and writers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
INT, FLOAT, DATE = T.IntegerType(), T.FloatType(), T.DateType()

#: Name of the column that carries the arrival position of a row.
SEQ = "_seq"
#: Name of the column that carries the number of the delivery a row came with, where deliveries are told apart.
DELIVERY = "_delivery"
SEQ_TYPE = "struct<modified:timestamp,file:string,block:bigint,position:bigint>"


@dataclass(frozen=True)
class Dataset:
    """One dataset: raw columns as they arrive, and the table contract they must meet."""

    name: str
    kind: str
    source: str
    key: tuple[str, ...]
    raw: dict[str, T.DataType]
    mart: dict[str, T.DataType]
    optional: frozenset[str] = frozenset()
    references: dict[str, str] = field(default_factory=dict)

    @property
    def table(self) -> str:
        return f"{self.kind}_{self.name}"

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.raw.items()])

    @property
    def text_schema(self) -> T.StructType:
        """Raw columns as text: nothing a source file holds is lost before the type rules have seen it."""
        return T.StructType([T.StructField(n, STRING) for n in self.raw])

    @property
    def mart_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, n in self.optional) for n, t in self.mart.items()])

    @property
    def required(self) -> list[str]:
        return [n for n in self.mart if n not in self.optional]


# The 15 whole-number statistics of one player in one match.
COUNT_STATS = (
    "minutes_played", "goals", "assists", "shots", "shots_on_target", "passes_attempted", "passes_completed",
    "key_passes", "tackles", "interceptions", "duels_won", "duels_lost", "fouls_committed", "yellow_cards",
    "red_cards",
)

TEAMS = Dataset(
    name="teams", kind="dim", source="csv", key=("team_id",),
    raw={n: STRING for n in ("team_id", "name", "league", "stadium", "city")},
    mart={n: STRING for n in ("team_id", "name", "league", "stadium", "city")},
)

PLAYERS = Dataset(
    name="players", kind="dim", source="csv", key=("player_id",),
    raw={
        "player_id": STRING, "name": STRING, "team_id": STRING, "position": STRING, "date_of_birth": STRING,
        "nationality": STRING, "market_value": DOUBLE, "contract_until": STRING,
    },
    mart={
        "player_id": STRING, "name": STRING, "team_id": STRING, "position": STRING, "date_of_birth": DATE,
        "nationality": STRING, "market_value": INT, "contract_until": DATE, "age": INT,
    },
    optional=frozenset({"market_value", "contract_until"}),
    references={"team_id": "teams"},
)

MATCHES = Dataset(
    name="matches", kind="dim", source="json", key=("match_id",),
    raw={
        "match_id": STRING, "competition": STRING, "season": STRING, "match_date": STRING, "home_team_id": STRING,
        "away_team_id": STRING, "home_score": LONG, "away_score": LONG, "venue": STRING, "attendance": LONG,
        "referee": STRING,
    },
    mart={
        "match_id": STRING, "competition": STRING, "season": STRING, "match_date": DATE, "home_team_id": STRING,
        "away_team_id": STRING, "home_score": INT, "away_score": INT, "venue": STRING, "attendance": INT,
        "referee": STRING,
    },
)

PLAYER_MATCH_STATS = Dataset(
    name="player_match_stats", kind="fact", source="csv", key=("player_id", "match_id"),
    raw={"player_id": STRING, "match_id": STRING, **{n: LONG for n in COUNT_STATS}, "xg": DOUBLE, "xa": DOUBLE},
    mart={
        "player_id": STRING, "match_id": STRING, **{n: INT for n in COUNT_STATS}, "xg": FLOAT, "xa": FLOAT,
        "goal_contribution": INT, "g_xg": FLOAT,
    },
    optional=frozenset({"xg", "xa", "g_xg"}),
    references={"player_id": "players", "match_id": "matches"},
)

MATCH_EVENTS = Dataset(
    name="match_events", kind="fact", source="json", key=("event_id",),
    raw={
        "event_id": STRING, "match_id": STRING, "minute": LONG, "second": LONG, "event_type": STRING,
        "player_id": STRING, "team_id": STRING, "x_start": DOUBLE, "y_start": DOUBLE, "x_end": DOUBLE,
        "y_end": DOUBLE, "outcome": STRING, "body_part": STRING, "pass_type": STRING, "recipient_id": STRING,
    },
    mart={
        "event_id": STRING, "match_id": STRING, "minute": INT, "second": INT, "event_type": STRING,
        "player_id": STRING, "team_id": STRING, "x_start": FLOAT, "y_start": FLOAT, "x_end": FLOAT, "y_end": FLOAT,
        "outcome": STRING, "body_part": STRING, "pass_type": STRING, "recipient_id": STRING,
    },
    optional=frozenset({"x_end", "y_end", "body_part", "pass_type", "recipient_id"}),
    references={"match_id": "matches", "team_id": "teams", "player_id": "players"},
)

#: Parents come before their children.
DATASETS = {d.name: d for d in (TEAMS, PLAYERS, MATCHES, PLAYER_MATCH_STATS, MATCH_EVENTS)}
