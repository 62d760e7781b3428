"""The metric lists of the season view, the team summary and the top list."""

from __future__ import annotations

from statline.operators.aggregates import Measure, Rate, Ratio
from statline.schemas import COUNT_STATS

MATCH_MINUTES = 90
TOP = 3

# The 19 season totals.
TOTALS = (
    "goals", "assists", "minutes_played", *COUNT_STATS[3:], "xg", "xa", "goal_contribution", "g_xg",
)


def _per_match(source: str) -> Rate:
    return Rate(source, "minutes_played", MATCH_MINUTES)


# The 17 derived columns in view order.
DERIVED: dict[str, Measure] = {
    "goals_90": _per_match("goals"),
    "assists_90": _per_match("assists"),
    "shot_accuracy": Ratio("shots_on_target", ("shots",)),
    "passes_attempted_90": _per_match("passes_attempted"),
    "passes_completed_90": _per_match("passes_completed"),
    "key_passes_90": _per_match("key_passes"),
    "pass_accuracy": Ratio("passes_completed", ("passes_attempted",)),
    "tackles_90": _per_match("tackles"),
    "interceptions_90": _per_match("interceptions"),
    "duel_win_rate": Ratio("duels_won", ("duels_won", "duels_lost")),
    "fouls_90": _per_match("fouls_committed"),
    "yellow_cards_90": _per_match("yellow_cards"),
    "red_cards_90": _per_match("red_cards"),
    "xg_90": _per_match("xg"),
    "xa_90": _per_match("xa"),
    "goal_contribution_90": _per_match("goal_contribution"),
    "g_xg_90": _per_match("g_xg"),
}

#: Columns a search can bound.
SEARCHABLE = ("age", *TOTALS, *DERIVED)

# Team summary: columns in order; means are unweighted means of per-player values.
SUMMARY_SUMS = ("xg", "xa", "g_xg")
SUMMARY_MEANS = ("age", "shot_accuracy", "pass_accuracy", "duel_win_rate")
SUMMARY_ORDER = (
    "age", "goals", "assists", "minutes_played", "shots", "shots_on_target", "shot_accuracy", "passes_attempted",
    "passes_completed", "pass_accuracy", "key_passes", "tackles", "interceptions", "duels_won", "duels_lost",
    "duel_win_rate", "fouls_committed", "yellow_cards", "red_cards", "xg", "xa", "g_xg",
)

TOP_COLUMNS = ("position", "age", "minutes_played", "goals", "assists", "goal_contribution")
