import pytest
from pyspark.sql import functions as F

from statline.operators.links import orphan_keys
from statline.plans.quality import check_all, check_dataset, quality_report, quality_summary
from tests.conftest import event, match, player, stats, team


def check(make, dataset, rows, **parents):
    return check_dataset(dataset, {dataset: make(dataset, rows), **parents})


def counts(result):
    row = result.summary.first()
    return row.total_rows, row.valid_rows, row.invalid_rows


def warned(result):
    return {(r.check, r.column): (r.n_keys, r.n_rows) for r in result.warnings.collect()}


def failures(result, *key):
    rows = result.violations.orderBy(*key, "place").collect()
    return [tuple(r[k] for k in key) + (r.kind, r.rule, r.column) for r in rows]


def test_a_sound_season(clean_raw):
    results = check_all(clean_raw)
    assert {r.dataset: (r.valid_rows, r.invalid_rows) for r in quality_summary(results).collect()} == {
        "teams": (3, 0), "players": (4, 0), "matches": (2, 0), "player_match_stats": (4, 0), "match_events": (3, 0)}
    assert {n: warned(r) for n, r in results.items()} == {
        "teams": {}, "players": {("labels", "position"): (4, 4)}, "matches": {}, "player_match_stats": {},
        "match_events": {}}


def test_teams(make):
    result = check(make, "teams", [team("T1"), team("T1"), team(None), team(None, city=None)])
    assert counts(result) == (4, 2, 2)
    assert warned(result) == {("duplicate", "team_id"): (2, 4)}
    assert len(failures(result, "team_id")) == 3


def test_players(make):
    teams = make("teams", [team("T1"), team("T1")])
    result = check(make, "players", [
        player("P1", position=None), player("P2", date_of_birth="1990/01/01", contract_until="never", market_value=-1.0),
        player("P3", "T9", date_of_birth=None, contract_until=None, market_value=None),
        player("P3", date_of_birth="24/06/1987"), player("P4", None, market_value=float("nan")),
    ], teams=teams)
    assert counts(result) == (5, 2, 3)
    assert failures(result, "player_id") == [
        ("P1", "field", "required", "position"), ("P2", "field", "date_layout", "date_of_birth"),
        ("P2", "field", "date_layout", "contract_until"), ("P2", "field", "range", "market_value"),
        ("P4", "field", "required", "team_id"), ("P4", "field", "range", "market_value")]
    assert warned(result) == {("orphan", "team_id"): (1, 1), ("duplicate", "player_id"): (1, 2), ("labels", "position"): (2, 5)}
    assert {r.column: (r.null_count, r.null_percentage) for r in result.nulls.collect()} == {
        "market_value": (1, 20.0), "contract_until": (1, 20.0)}
    assert {r.position: r.n_rows for r in result.labels["position"].collect()} == {"striker": 4, None: 1}


def test_matches(make):
    result = check(make, "matches", [match("M1"), match("M2", home_score=-1, attendance=-5, match_date="yesterday"),
                                     match("M3", venue=None), match("M1", away_score=None)])
    assert counts(result) == (4, 1, 3)
    assert failures(result, "match_id")[1:] == [
        ("M2", "field", "range", "home_score"), ("M2", "field", "range", "attendance"),
        ("M2", "field", "date_layout", "match_date"), ("M3", "field", "required", "venue")]
    assert warned(result) == {("duplicate", "match_id"): (1, 2)}


def test_cross_field_rules_wait_for_sound_fields(make):
    players, matches = make("players", [player("P1")]), make("matches", [match("M1")])
    result = check(make, "player_match_stats", [
        stats("P1", "M1", shots=1, shots_on_target=2, passes_completed=5, xg=3.0),
        stats("P1", "M2", shots=1, shots_on_target=2, yellow_cards=3, xg=-0.5),
        stats("P2", "M1", passes_completed=5, xg=3.0), stats("P3", "M1", xg=0.5),
        stats("P4", "M1", shots=2, xg=2.0, red_cards=2), stats("P5", "M1", goals=None, shots_on_target=1),
        stats("P6", "M1", xg=float("nan")),
    ], players=players, matches=matches)
    assert failures(result, "player_id", "match_id") == [
        ("P1", "M1", "cross", "shots_on_target", "shots_on_target"), ("P1", "M2", "field", "range", "yellow_cards"),
        ("P1", "M2", "field", "range", "xg"), ("P2", "M1", "cross", "passes_completed", "passes_completed"),
        ("P3", "M1", "cross", "xg_above_shots", "xg"), ("P4", "M1", "field", "range", "red_cards"),
        ("P5", "M1", "field", "required", "goals"), ("P6", "M1", "field", "range", "xg")]
    assert counts(result) == (7, 0, 7)
    assert warned(result) == {("orphan", "player_id"): (5, 5), ("orphan", "match_id"): (1, 1)}


def test_duplicate_statistics_are_named_by_both_keys(make):
    result = check(make, "player_match_stats", [stats("P1", "M1"), stats("P1", "M1"), stats("P1", "M2")])
    assert [tuple(r) for r in result.duplicates.collect()] == [("P1-M1", 2)]


def test_events(make):
    sound = {"event_type": "pass", "x_end": 1.0, "y_end": 2.0, "pass_type": "cross", "recipient_id": "P2", "body_part": "head"}
    result = check(make, "match_events", [
        event("E1", **sound), event("E2", minute=-1, second=60, x_start=100.5, y_start=None, event_type="pass"),
        event("E3", **{**sound, "y_end": None, "pass_type": None}), event("E4", **{**sound, "pass_type": None}),
        event("E5", **{**sound, "recipient_id": None}), event("E6", **{**sound, "body_part": None}),
        event("E7", event_type="shot"), event("E8", x_end=-1.0), event("E9", outcome=None),
    ])
    assert failures(result, "event_id") == [
        ("E2", "field", "required", "y_start"), ("E2", "field", "range", "minute"), ("E2", "field", "range", "second"),
        ("E2", "field", "range", "x_start"), ("E3", "cross", "destination", "x_end"),
        ("E4", "cross", "pass_type", "pass_type"), ("E5", "cross", "recipient", "recipient_id"),
        ("E6", "cross", "body_part", "body_part"), ("E7", "cross", "body_part", "body_part"),
        ("E8", "field", "range", "x_end"), ("E9", "field", "required", "outcome")]


def test_absent_columns(make):
    events = make("match_events", [event("E1")])
    assert counts(check_dataset("match_events", {"match_events": events.drop("x_start", "x_end")})) == (1, 1, 0)
    assert counts(check_dataset("match_events", {"match_events": events.drop("outcome")})) == (1, 0, 1)


@pytest.mark.parametrize("text,valid", [("3", 1), ("3.0", 1), ("1.5", 0), ("x", 0)])
def test_numbers_as_text(make, text, valid):
    matches = make("matches", [match("M1")]).withColumn("attendance", F.lit(text))
    result = check_dataset("matches", {"matches": matches})
    assert counts(result) == (1, valid, 1 - valid)
    assert [r.rule for r in result.violations.collect()] == ["type"] * (1 - valid)


def test_empty_and_absent_datasets(make):
    results = check_all({"teams": make("teams", [])})
    assert {r.dataset: (r.total_rows, r.valid_percentage) for r in quality_summary(results).collect()} == {
        n: (0, 0.0) for n in results}
    assert all(("empty", "") in warned(r) for r in results.values())


def test_report(make, clean_raw):
    events = [event(f"E{i}", team_id="T9") for i in range(2)]
    raw = dict(clean_raw, teams=make("teams", [team("T1"), team("T1"), team("T2", city=None)]),
               match_events=make("match_events", events))
    rows = {(r.dataset, r.section, r.item): r.detail for r in quality_report(check_all(raw)).collect()}
    assert rows["teams", "rows", "teams"] == "3 rows, 2 correct (66.7%)"
    assert rows["teams", "errors", "T2"] == "city value is missing"
    assert rows["players", "nulls", "market_value"] == "0 (0.0%)"
    assert rows["players", "warnings", "labels position"] == "4 keys, 4 rows"
    assert rows["players", "labels", "position striker"] == "1 rows"
    assert rows["match_events", "orphans", "team_id T9"] == "2 rows"
    assert rows["teams", "duplicates", "T1"] == "2 rows"
    assert len([k for k in rows if k[1] == "errors"]) == 1


def test_nothing_to_check():
    with pytest.raises(ValueError):
        check_all({})


def test_orphan_keys_take_one_aggregation(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",)], "k string")
    parent = spark.createDataFrame([("b",), ("b",), (None,), ("z",)], "p string")
    found = orphan_keys(child, "k", parent, "p")
    assert sorted(map(tuple, found.collect())) == [("a", 2), ("c", 1)]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_orphan_keys_of_unlike_types(spark):
    child = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "k string")
    found = orphan_keys(child, "k", spark.createDataFrame([(1,), (1,)], "p long"), "p")
    assert sorted(map(tuple, found.collect())) == [("2", 2)]
