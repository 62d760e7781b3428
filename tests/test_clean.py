import datetime as dt

from pyspark.sql import functions as F

from statline.operators import conform, keep_last, split_contract, upsert
from statline.operators.keys import keep_last_of_repeated
from statline.plans.clean import clean_all, clean_match_events, clean_matches, clean_player_match_stats, clean_players, clean_teams
from statline.schemas import DATASETS
from statline.session import stored_in
from tests.conftest import event, match, player, stats, team

DAY = dt.date(2024, 1, 1)


def test_teams_keep_the_last_copy(make):
    rows = clean_teams(make("teams", [team("T1", name="Old"), team("T2"), team("T1", name="New")])).collect()
    assert {r.team_id: r.name for r in rows} == {"T1": "New", "T2": "Club T2"}


def test_players(make):
    teams = make("teams", [team("T1"), team("T2")])
    raw = make("players", [
        player("P1", position=None, date_of_birth="24/06/1990"),
        player("P2", "T9"),
        player("P3", position="GK"),
        player("P3", "T2", position="CB", date_of_birth="no date", contract_until=None),
        player("P4", "T1", name="kept"), player("P4", "T9", name="orphan"),
        player("P5", None),
    ])
    rows = {r.player_id: r for r in clean_players(raw, teams, DAY).collect()}
    assert set(rows) == {"P1", "P3", "P4"}
    assert (rows["P1"].position, rows["P1"].date_of_birth, rows["P1"].age) == ("Unknown", dt.date(1990, 6, 24), 33)
    assert (rows["P3"].team_id, rows["P3"].position, rows["P3"].date_of_birth, rows["P3"].age) == ("T2", "Defender", None, None)
    assert rows["P4"].name == "kept"  # the orphaned later copy goes before the last copy is picked


def test_matches(make):
    raw = make("matches", [match("M1", match_date="03/02/2024"), match("M1", match_date="25/02/2024"), match("M2")])
    rows = {r.match_id: r.match_date for r in clean_matches(raw).collect()}
    assert rows == {"M1": dt.date(2024, 2, 25), "M2": dt.date(2024, 2, 3)}
    assert {r.match_date for r in clean_matches(raw.limit(1), day_first=True).collect()} == {dt.date(2024, 2, 3)}


def test_player_match_stats(make):
    players, matches = make("players", [player("P1"), player("P2")]), make("matches", [match("M1"), match("M2")])
    raw = make("player_match_stats", [
        stats("P1", "M1", goals=9), stats("P1", "M1", goals=2, assists=1, shots=3, xg=0.5),
        stats("P1", "M2", goals=1, shots=1, xg=1.5), stats("P2", "M1", goals=1, shots=4, xg=-0.1),
        stats("P2", "M2", xg=None), stats("P9", "M1"), stats("P1", "M9"),
    ])
    rows = {(r.player_id, r.match_id): r for r in clean_player_match_stats(raw, players, matches).collect()}
    assert set(rows) == {("P1", "M1"), ("P1", "M2"), ("P2", "M1"), ("P2", "M2")}
    first = rows["P1", "M1"]
    assert (first.goals, first.goal_contribution, first.xg, first.g_xg) == (2, 3, 0.5, 1.5)
    assert all(rows[k].xg is None and rows[k].g_xg is None for k in rows if k != ("P1", "M1"))


def test_statistics_cleaned_by_stored_keys(spark, make, tmp_path, monkeypatch):
    players, matches = make("players", [player("P1"), player("P2")]), make("matches", [match("M1"), match("M2")])
    raw = make("player_match_stats", [
        stats("P1", "M1", goals=9), stats("P1", "M1", goals=2, xg=0.5), stats("P1", "M2"), stats("P2", "M1", xg=-0.1),
        stats("P9", "M1"), stats("P1", "M9"), stats(None, "M1"), stats(None, "M1"), stats("P2", None),
    ])
    plain = sorted(clean_player_match_stats(raw, players, matches).collect())
    for few in (500_000, 0):
        monkeypatch.setattr("statline.operators.keys.FEW_KEYS", few)
        store = stored_in(spark, str(tmp_path / f"keys{few}"))
        assert sorted(clean_player_match_stats(raw, players, matches, store=store).collect()) == plain


def test_rows_of_single_keys_are_not_shuffled(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, 1), (1, None, 2), (1, "a", 3), (2, "a", 4), (2, "a", 5), (None, None, 6)],
                                 "k int, m string, seq int")
    store = stored_in(spark, str(tmp_path))
    kept = keep_last_of_repeated(rows, ["k", "m"], ["seq"], rows, lambda keys: store("repeated", keys))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.seq for r in kept.collect()) == [2, 3, 5, 6]
    assert plan.index("LeftAnti") < plan.index("Window") < plan.index("LeftSemi")
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_match_events(make):
    parents = [make("matches", [match("M1")]), make("teams", [team("T1")]), make("players", [player("P1")])]
    raw = make("match_events", [event("E1", minute=1), event("E1", minute=2), event("E1", match_id="M9", minute=3),
                                event("E2", team_id="T9"), event("E3", player_id="P9"), event("E4", team_id=None)])
    assert [(r.event_id, r.minute) for r in clean_match_events(raw, *parents).collect()] == [("E1", 2)]


def test_cascade_uses_cleaned_parents(make, clean_raw):
    raw = dict(clean_raw, players=make("players", [player("P1"), player("P2", "T9")]))
    cleaned = clean_all(raw, dt.date(2024, 1, 1))
    assert {r.player_id for r in cleaned["player_match_stats"].collect()} == {"P1"}
    assert {r.event_id for r in cleaned["match_events"].collect()} == {"E1", "E2"}


def test_child_without_parents_is_left_out(clean_raw):
    cleaned = clean_all({n: clean_raw[n] for n in ("teams", "player_match_stats")})
    assert list(cleaned) == ["teams"]


def test_text_numbers_are_cast_and_bad_ones_nulled(spark, make):
    raw = make("matches", [match("M1"), match("M2")]).withColumn(
        "attendance", F.when(F.col("match_id") == "M1", "70.0").otherwise("many"))
    assert {r.match_id: r.attendance for r in clean_matches(raw).collect()} == {"M1": 70, "M2": None}


def test_keep_last_by_several_columns(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (1, 2, 4), (2, 1, None), (None, 1, 1), (None, 2, 2)],
                               "k int, a int, b int")
    rows = sorted(map(tuple, keep_last(df, ["k"], ["a", "b"]).collect()), key=str)
    assert rows == [(1, 2, 4), (2, 1, None), (None, 2, 2)]


def test_contract_splits_rows(spark):
    schema = DATASETS["teams"].mart_schema
    df = spark.createDataFrame([("T1", "a", "b", "c", "d", 1), ("T2", None, "b", "c", "d", 2)],
                               "city string, league string, name string, stadium string, team_id string, more int")
    good, broken = split_contract(df, schema)
    assert good.columns == ["team_id", "name", "league", "stadium", "city"]
    assert [r.city for r in good.collect()] == ["T1"]
    assert [(r.city, r.more) for r in broken.collect()] == [("T2", 2)]


def test_contract_refuses_values_that_do_not_fit(spark):
    schema = DATASETS["players"].mart_schema
    row = ("P1", "n", "T1", "Forward", dt.date(2000, 1, 1), "x", 3e12, None, 24)
    df = spark.createDataFrame([row, ("P2", *row[1:6], 10.0, None, 24)],
                               "player_id string, name string, team_id string, position string, date_of_birth date, "
                               "nationality string, market_value double, contract_until date, age int")
    good, broken = split_contract(df, schema)
    assert [(r.player_id, r.market_value) for r in good.collect()] == [("P2", 10)]
    assert [r.player_id for r in broken.collect()] == ["P1"]


def test_conform_adds_absent_optional_columns(clean_raw):
    fitted = conform(clean_raw["match_events"].drop("pass_type"), DATASETS["match_events"].mart_schema)
    assert fitted.columns == list(DATASETS["match_events"].mart)
    assert fitted.filter("pass_type is not null").isEmpty()


def test_upsert_replaces_by_composite_key(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x")], "p string, m int, v string")
    new = spark.createDataFrame([("y", "a", 2), ("y", "c", 1)], "v string, p string, m int")
    assert sorted(map(tuple, upsert(old, new, ["p", "m"]).select("p", "m", "v").collect())) == [
        ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("c", 1, "y")]
