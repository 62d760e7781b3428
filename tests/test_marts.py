import datetime as dt

import pytest
from pyspark.sql import functions as F

from statline.operators import range_filter, split_contract, top_n_per_group
from statline.plans.clean import clean_all
from statline.plans.metrics import DERIVED, SEARCHABLE, TOTALS
from statline.plans.marts import FORMS, player_view, search_players, team_summary, team_top
from statline.plans.reports import PROFILES, profile
from statline.schemas import DATASETS


@pytest.fixture(scope="module")
def tables(clean_raw):
    cleaned = clean_all(clean_raw, dt.date(2024, 1, 1))
    return {n: split_contract(df, DATASETS[n].mart_schema)[0].cache() for n, df in cleaned.items()}


@pytest.fixture(scope="module", params=FORMS)
def form(request):
    return request.param


@pytest.fixture(scope="module")
def view(tables, form):
    return player_view(tables["players"], tables["teams"], tables["player_match_stats"], form).cache()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_metric_lists():
    assert (len(TOTALS), len(DERIVED), len(SEARCHABLE)) == (19, 17, 37)


def test_view_shape(view):
    assert len(view.columns) == len(set(view.columns)) == 46
    assert view.columns[:10] == list(DATASETS["players"].mart) + ["team_name"]


def test_view_values(view):
    by_key = {r.player_id: r for r in view.collect()}
    assert set(by_key) == {"P1", "P2", "P3", "P4"}
    p1, p2, p3, p4 = (by_key[k] for k in ("P1", "P2", "P3", "P4"))
    assert (p1.team_name, p1.minutes_played, p1.goals, p1.goal_contribution, p1.xg, p1.g_xg) == ("Club T1", 135, 3, 4, 1.75, 1.25)
    assert (p1.goals_90, p1.goal_contribution_90, p1.xg_90) == (2.0, 2.67, 1.17)
    assert (p1.shot_accuracy, p1.pass_accuracy, p1.duel_win_rate) == (0.67, 0.8, 0.67)
    assert (p2.shot_accuracy, p2.g_xg, p2.duel_win_rate) == (0.0, -0.5, 1.0)
    assert (p3.shot_accuracy, p3.pass_accuracy, p3.duel_win_rate, p3.goals_90) == (None, 1.0, None, 0.0)
    assert all(p4[c] is None for c in (*TOTALS, *DERIVED)) and p4.age == 28


def test_default_search_drops_null_and_negative_metrics(view, form):
    assert [r.player_id for r in search_players(view, form=form).collect()] == ["P1"]


def test_open_search_keeps_all_in_order(view, form):
    opened = {f"{c}_min": None for c in SEARCHABLE}
    assert [r.player_id for r in search_players(view, form=form, **opened).collect()] == ["P1", "P2", "P3", "P4"]


def test_bounded_search(view, form):
    found = search_players(view, "Goalkeeper", form, g_xg_min=None, g_xg_90_min=None, shots_max=1)
    assert [r.player_id for r in found.collect()] == ["P2"]
    assert search_players(view, form=form, goals_min=4).isEmpty()
    assert search_players(view, "Goal'keeper", form).isEmpty()


def test_search_refuses_unknown_limits(view):
    with pytest.raises(TypeError):
        search_players(view, goal_min=3)


@pytest.mark.parametrize("build", [
    lambda v, t, f: player_view(t["players"], t["teams"], t["player_match_stats"], f),
    lambda v, t, f: search_players(v, form=f), lambda v, t, f: team_summary(v, t["teams"], form=f),
    lambda v, t, f: team_top(v, t["teams"], form=f),
])
def test_unknown_form(view, tables, build):
    with pytest.raises(ValueError):
        build(view, tables, "polars")


def test_team_summary(view, tables, form):
    summary = team_summary(view, tables["teams"], form=form)
    assert len(summary.columns) == 24 and summary.columns[:3] == ["league", "team_name", "avg_age"]
    found = {r.team_name: r for r in summary.collect()}
    assert list(found) == ["Club T1", "Club T2"]
    one, two = found["Club T1"], found["Club T2"]
    assert (one.avg_age, one.total_goals, one.total_minutes_played) == (28.0, 3, 165)
    assert (one.avg_pass_accuracy, one.avg_shot_accuracy, one.total_xg) == (0.9, 0.67, 1.75)
    assert (two.total_goals, two.total_g_xg, two.avg_duel_win_rate) == (0, -0.5, 1.0)
    assert rows(team_summary(view, tables["teams"], "T2", form)) == [tuple(two)]


def test_team_top(view, tables, form):
    best = team_top(view, tables["teams"], n=1, form=form)
    assert [(r.team_name, r.player_name, r.goal_contribution) for r in best.collect()] == [
        ("Club T1", "Player P1", 4), ("Club T2", "Player P2", 0)]
    # A player without matches ranks last but fills a thin team.
    listed = team_top(view, tables["teams"], "T2", form=form)
    assert [(r.player_name, r.goal_contribution) for r in listed.collect()] == [("Player P2", 0), ("Player P4", None)]


def test_profiles(view, form):
    for name, wanted in PROFILES.items():
        found = profile(view, name, form)
        assert found.columns == list(wanted.columns)
    assert profile(view.withColumn("goals", F.lit(5)).withColumn("g_xg", F.lit(2.0)), "effective_scorers", form).count() == 1


def test_range_filter_without_conditions(view):
    assert range_filter(view, {"age": (None, None)}, {"position": None}).count() == 4


def test_ties_go_to_the_order_columns(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 5), ("b", 4, None)], "g string, k int, v int")
    best = top_n_per_group(df, ["g"], [F.desc_nulls_last("v"), F.asc("k")], 2, rank="r")
    assert sorted(rows(best.select("g", "k", "r"))) == [("a", 1, 1), ("a", 2, 2), ("b", 4, 1)]
