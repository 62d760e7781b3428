import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from statline.schemas import COUNT_STATS, DATASETS  # noqa: E402
from statline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
                            spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """``make(dataset, [row dict, ...])``: rows in the raw schema, absent columns null, ``_seq`` by position."""
    def build(dataset, rows):
        names = list(DATASETS[dataset].raw)
        types = ", ".join(f"{n} {t.simpleString()}" for n, t in DATASETS[dataset].raw.items())
        data = [tuple(row.get(n) for n in names) + (i,) for i, row in enumerate(rows)]
        return spark.createDataFrame(data, f"{types}, _seq bigint")
    return build


def team(key, **values):
    return {"team_id": key, "name": f"Club {key}", "league": "First", "stadium": "Ground", "city": "Town", **values}


def player(key, team_id="T1", **values):
    return {"player_id": key, "name": f"Player {key}", "team_id": team_id, "position": "striker",
            "date_of_birth": "1995-03-10", "nationality": "Wales", "market_value": 1000.0,
            "contract_until": "2026-06-30", **values}


def match(key, **values):
    return {"match_id": key, "competition": "Cup", "season": "2024", "match_date": "2024-02-03", "home_team_id": "T1",
            "away_team_id": "T2", "home_score": 2, "away_score": 0, "venue": "Ground", "attendance": 500,
            "referee": "Ref", **values}


def stats(player_id, match_id, **values):
    return {"player_id": player_id, "match_id": match_id, **{c: 0 for c in COUNT_STATS}, "xg": 0.0, "xa": 0.0, **values}


def event(key, **values):
    return {"event_id": key, "match_id": "M1", "minute": 5, "second": 30, "event_type": "tackle", "player_id": "P1",
            "team_id": "T1", "x_start": 10.0, "y_start": 20.0, "outcome": "won", **values}


@pytest.fixture(scope="session")
def clean_raw(make):
    """A small season without faults: two players with matches, one without shots, one without matches."""
    return {
        "teams": make("teams", [team("T1"), team("T2"), team("T3")]),
        "players": make("players", [player("P1"), player("P2", "T2", position="GK"), player("P3", position="CM"),
                                    player("P4", "T2", position="cb")]),
        "matches": make("matches", [match("M1"), match("M2")]),
        "player_match_stats": make("player_match_stats", [
            stats("P1", "M1", minutes_played=90, goals=2, assists=1, shots=4, shots_on_target=3, passes_attempted=40,
                  passes_completed=30, duels_won=3, duels_lost=1, xg=1.5),
            stats("P1", "M2", minutes_played=45, goals=1, shots=2, shots_on_target=1, passes_attempted=20,
                  passes_completed=18, duels_won=1, duels_lost=1, xg=0.25),
            stats("P2", "M1", minutes_played=90, goals=0, shots=1, passes_attempted=10, passes_completed=7,
                  duels_won=1, xg=0.5),
            stats("P3", "M2", minutes_played=30, passes_attempted=8, passes_completed=8),
        ]),
        "match_events": make("match_events", [
            event("E1"),
            event("E2", event_type="pass", x_end=30.0, y_end=40.0, body_part="head", pass_type="cross",
                  recipient_id="P3"),
            event("E3", event_type="shot", body_part="head", player_id="P2", team_id="T2"),
        ]),
    }
