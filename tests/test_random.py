"""Random tables against plain Python: what the operators must give, worked out row by row."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from statline.operators import (
    drop_orphans, duplicate_keys, keep_last, keep_matching, orphan_keys, range_filter, top_n_per_group, upsert,
)
from statline.plans.clean import clean_player_match_stats
from statline.plans.marts import player_season
from statline.plans.rulebook import rules_for
from statline.session import stored_in
from tests.conftest import match, player, stats


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(params=range(3))
def draw(request):
    return random.Random(request.param)


@pytest.fixture
def data(draw):
    """(key, value, seq) rows; a third of the rows share key 0, some keys and values are null."""
    def key():
        return draw.choice([0, draw.randint(1, 40), draw.randint(1, 400)]) if draw.random() < 0.95 else None
    return [(key(), draw.choice([None, draw.randint(-5, 5)]), i) for i in range(600)]


@pytest.fixture
def frame(spark, data):
    return spark.createDataFrame(data, "k int, v int, seq int").repartition(5)


def test_keyed_groups(frame, data):
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    assert rows(keep_last(frame, ["k"], ["seq"])) == sorted([max(g, key=lambda r: r[2]) for g in groups.values()], key=repr)
    repeated = [(k, len(g)) for k, g in groups.items() if len(g) > 1]
    assert rows(duplicate_keys(frame, ["k"])) == sorted(repeated, key=repr)
    best = [r for g in groups.values() for r in sorted(g, key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))[:3]]
    order = [F.desc_nulls_last("v"), F.asc("seq")]
    assert rows(top_n_per_group(frame, ["k"], order, 3)) == sorted(best, key=repr)


def test_links(spark, frame, data, draw, tmp_path):
    known = draw.sample(range(400), 150)
    parent = spark.createDataFrame([(k,) for k in known] * 2 + [(None,)], "id int")
    linked = sorted([r for r in data if r[0] in known], key=repr)
    assert rows(keep_matching(frame, {"k": (parent, "id")})) == linked
    unique = {"k": (parent.distinct(), "id")}
    stored = drop_orphans(frame, unique, frame, stored_in(spark, str(tmp_path)))
    assert rows(stored) == linked
    missing = Counter(r[0] for r in data if r[0] is not None and r[0] not in known)
    assert rows(orphan_keys(frame, "k", parent, "id")) == sorted(missing.items(), key=repr)


def test_range_filter(frame, data):
    found = range_filter(frame, {"v": (-2, 3), "seq": (None, 500)}, {"k": 0})
    assert rows(found) == sorted([r for r in data if r[0] == 0 and r[1] is not None and -2 <= r[1] <= 3 and r[2] <= 500],
                                 key=repr)


def test_upsert(spark, data):
    old = {r[2]: r for r in data[:400]}
    new = {r[2]: (r[0], 99, r[2]) for r in data[300:]}
    schema = "k int, v int, seq int"
    merged = upsert(spark.createDataFrame(list(old.values()), schema), spark.createDataFrame(list(new.values()), schema), ["seq"])
    assert rows(merged) == sorted({**old, **new}.values(), key=repr)


@pytest.fixture
def lines(draw):
    def line():
        number = lambda high: draw.choice([0, draw.randint(0, high), draw.randint(-1, high)])
        names = ("minutes_played", "goals", "assists", "shots", "shots_on_target", "passes_attempted", "passes_completed",
                 "yellow_cards", "red_cards")
        values = {n: number(4) for n in names}
        return stats(draw.choice(["P1", f"P{draw.randint(1, 9)}", None]), f"M{draw.randint(1, 9)}", **values,
                     xg=draw.choice([None, draw.randint(-2, 24) / 8]))
    return [line() for _ in range(300)]


def test_statistics_cleaned_and_summed(make, lines):
    players, matches = make("players", [player(f"P{i}") for i in range(1, 7)]), make("matches", [match(f"M{i}") for i in range(1, 8)])
    last = {}
    for row in lines:
        if row["player_id"] in [f"P{i}" for i in range(1, 7)] and row["match_id"] in [f"M{i}" for i in range(1, 8)]:
            last[row["player_id"], row["match_id"]] = row
    expected = defaultdict(lambda: [0, 0, None, None])
    for row in last.values():
        xg = None if row["xg"] is None or row["xg"] < 0 or row["xg"] > row["shots"] else row["xg"]
        total = expected[row["player_id"]]
        total[0] += row["minutes_played"]
        total[1] += row["goals"] + row["assists"]
        if xg is not None:
            total[2] = (total[2] or 0) + xg
            total[3] = (total[3] or 0) + row["goals"] - xg
    season = player_season(clean_player_match_stats(make("player_match_stats", lines), players, matches))
    assert rows(season.select("player_id", "minutes_played", "goal_contribution", "xg", "g_xg")) == sorted(
        [(k, *v) for k, v in expected.items()], key=repr)


def test_statistics_rules(make, lines):
    def failures(row):
        found = [("required", n) for n in ("player_id", "xg") if row[n] is None]
        for n in ("minutes_played", "goals", "assists", "shots", "shots_on_target", "passes_attempted", "passes_completed"):
            found += [("range", n)] if row[n] < 0 else []
        found += [("range", "yellow_cards")] if not 0 <= row["yellow_cards"] <= 2 else []
        found += [("range", "red_cards")] if not 0 <= row["red_cards"] <= 1 else []
        found += [("range", "xg")] if row["xg"] is not None and row["xg"] < 0 else []
        if not found:
            if row["shots_on_target"] > row["shots"]:
                found = [("shots_on_target", "shots_on_target")]
            elif row["passes_completed"] > row["passes_attempted"]:
                found = [("passes_completed", "passes_completed")]
            elif row["xg"] > row["shots"]:
                found = [("xg_above_shots", "xg")]
        return found

    df = make("player_match_stats", lines)
    rules = rules_for("player_match_stats", df)
    expected = [(i, *f) for i, row in enumerate(lines) for f in failures(row)]
    assert rows(rules.violations(df, ["_seq"]).select("_seq", "rule", "column")) == sorted(expected, key=repr)
    first = [(i, *failures(row)[0]) for i, row in enumerate(lines) if failures(row)]
    assert rows(rules.first_violation(df, ["_seq"]).select("_seq", "rule", "column")) == sorted(first, key=repr)
    assert df.filter(rules.invalid).count() == len(first)
