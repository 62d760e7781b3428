"""Deliveries in any order, by call and by stream."""

import datetime as dt
import json
import random

import pytest

from statline.operators import split_contract
from statline.plans.clean import clean_all
from statline.plans.intake import Intake, waiting_table
from statline.schemas import DATASETS, DELIVERY
from statline.sources import Warehouse
from statline.streaming import landing, stream_to_landing, stream_to_tables
from tests.conftest import event, match, player, stats, team
from tests.test_sources import write_csv

AS_OF = dt.date(2024, 1, 1)


@pytest.fixture
def intake(spark, tmp_path):
    return Intake(Warehouse(spark, str(tmp_path / "wh")), AS_OF)


def rows(df):
    return [] if df is None else sorted(map(repr, (tuple(r) for r in df.collect())))


def table(intake, dataset):
    return intake.warehouse.read(DATASETS[dataset].table)


def waits(intake, dataset):
    df = intake.waiting(dataset)
    return [] if df is None else sorted(tuple(r[k] for k in DATASETS[dataset].key) for r in df.collect())


def test_children_before_parents_equal_one_cleaning(spark, make, clean_raw, tmp_path):
    whole = clean_all(clean_raw, AS_OF)
    wanted = {n: rows(split_contract(df, DATASETS[n].mart_schema)[0]) for n, df in whole.items()}
    mixed = ("players", "match_events", "teams", "player_match_stats", "matches")
    for number, order in enumerate([mixed]):
        intake = Intake(Warehouse(spark, str(tmp_path / f"wh{number}")), AS_OF)
        for delivery, name in enumerate(order):
            intake.deliver({name: clean_raw[name]}, delivery)
        assert {n: rows(table(intake, n)) for n in DATASETS} == wanted
        assert not any(waits(intake, n) for n in DATASETS)


def test_one_parent_takes_along_all_that_waited(intake, make):
    intake.deliver({"match_events": make("match_events", [event("E1"), event("E2", player_id="P9"), event("E3", player_id=None)])}, 0)
    intake.deliver({"players": make("players", [player("P1")]), "matches": make("matches", [match("M1")])}, 0)
    assert waits(intake, "match_events") == [("E1",), ("E2",)] and waits(intake, "players") == [("P1",)]
    moved = intake.deliver({"teams": make("teams", [team("T1")])}, 0)
    assert waits(intake, "match_events") == [("E2",)] and not waits(intake, "players")
    assert [r.event_id for r in table(intake, "match_events").collect()] == ["E1"]
    assert (moved["match_events"].saved, moved["match_events"].waiting) == (1, 1)


def test_an_older_copy_does_not_come_back_over_a_newer_one(intake, make):
    intake.deliver({"teams": make("teams", [team("T1")])}, 0)
    intake.deliver({"players": make("players", [player("P1", "T2", name="older"), player("P2", "T2", name="older")])}, 0)
    intake.deliver({"players": make("players", [player("P1", name="newer"), player("P2", "T3", name="newer")])}, 1)
    assert waits(intake, "players") == [("P2",), ("P2",)]
    intake.deliver({"teams": make("teams", [team("T2")])}, 1)
    names = lambda: {r.player_id: r["name"] for r in table(intake, "players").collect()}
    assert names() == {"P1": "newer", "P2": "older"} and waits(intake, "players") == [("P2",)]
    intake.deliver({"teams": make("teams", [team("T3")])}, 2)
    assert names() == {"P1": "newer", "P2": "newer"} and not waits(intake, "players")


def test_random_deliveries_equal_cleaning_all_rows_at_once(spark, make, tmp_path):
    rnd = random.Random(11)
    for trial in range(1):
        intake, all_rows = Intake(Warehouse(spark, str(tmp_path / f"wh{trial}")), AS_OF), {n: [] for n in DATASETS}
        numbers = {n: 0 for n in DATASETS}
        for _ in range(7):
            name = rnd.choice(list(DATASETS))
            pick = lambda kind, n: f"{kind}{rnd.randrange(n)}"
            mark = f"copy {rnd.random()}"
            new = {
                "teams": lambda: team(pick("T", 4), name=mark), "matches": lambda: match(pick("M", 4), venue=mark),
                "players": lambda: player(pick("P", 4), pick("T", 5), name=mark),
                "player_match_stats": lambda: stats(pick("P", 5), pick("M", 5), goals=rnd.randrange(9)),
                "match_events": lambda: event(pick("E", 5), player_id=pick("P", 5), match_id=pick("M", 5),
                                              team_id=pick("T", 5), minute=rnd.randrange(90)),
            }[name]
            delivered = [new() for _ in range(rnd.randrange(1, 6))]
            all_rows[name] += delivered
            intake.deliver({name: make(name, delivered)}, numbers[name])
            if rnd.random() < 0.3:  # the same delivery once more
                intake.deliver({name: make(name, delivered)}, numbers[name])
            numbers[name] += 1
        whole = clean_all({n: make(n, r) for n, r in all_rows.items()}, AS_OF)
        for n, df in whole.items():
            assert rows(table(intake, n)) == rows(split_contract(df, DATASETS[n].mart_schema)[0]), (trial, n)


def test_rows_that_break_the_contract_are_kept_once_and_known_to_children(intake, make):
    broken = {"players": make("players", [player("P1", name=None), player("P2")])}
    intake.deliver({"teams": make("teams", [team("T1")]), "matches": make("matches", [match("M1")])}, 0)
    for _ in range(2):
        intake.deliver(broken, 0)
    assert [r.player_id for r in intake.warehouse.read("dim_players_quarantine").collect()] == ["P1"]
    intake.deliver({"player_match_stats": make("player_match_stats", [stats("P1", "M1"), stats("P3", "M1")])}, 0)
    assert [r.player_id for r in table(intake, "player_match_stats").collect()] == ["P1"]
    assert waits(intake, "player_match_stats") == [("P3", "M1")]


def test_empty_deliveries_change_nothing(intake, make):
    intake.deliver({n: make(n, []) for n in DATASETS}, 0)
    assert all(table(intake, n) is None and not waits(intake, n) for n in DATASETS)


# --- by stream -------------------------------------------------------------------------------------------------------------

def run(spark, intake, root, dataset):
    query = stream_to_tables(spark, dataset, str(root / "raw"), intake, str(root / "odd"), str(root / "checkpoint"))
    query.awaitTermination()


def odd(spark, path):
    return spark.read.parquet(str(path)).collect()


def test_stream_fills_tables_and_keeps_what_is_no_row(spark, intake, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "matches_1.json").write_text(json.dumps([match("M1"), 7, match("M2")]))
    (raw / "matches_2.json").write_text('[{"match_id": "M3"')
    run(spark, intake, tmp_path, "matches")
    assert sorted(r.match_id for r in table(intake, "matches").collect()) == ["M1", "M2"]
    kept = odd(spark, tmp_path / "odd" / "matches")
    assert sorted((r.file.rsplit("/", 1)[1], r._text) for r in kept) == [("matches_1.json", "7"), ("matches_2.json", None)]
    write_csv(raw / "players_1.csv", "players", [player("P1"), player("P2", "T2")])
    with open(raw / "players_1.csv", "a") as file:
        file.write("P3,too,short\n")
    run(spark, intake, tmp_path, "players")
    assert waits(intake, "players") == [("P1",), ("P2",)]
    assert ["P3,too,short" in r._corrupt_record for r in odd(spark, tmp_path / "odd" / "players")] == [True]
    write_csv(raw / "teams_1.csv", "teams", [team("T1"), team("T2")])
    run(spark, intake, tmp_path, "teams")
    assert sorted(r.player_id for r in table(intake, "players").collect()) == ["P1", "P2"]
    # A changed file is taken, an unchanged one is not.
    write_csv(raw / "players_1.csv", "players", [player("P1", name="A longer name than before")])
    run(spark, intake, tmp_path, "players")
    assert {r.player_id: r["name"] for r in table(intake, "players").collect()} == {
        "P1": "A longer name than before", "P2": "Player P2"}


def test_a_batch_that_comes_again_changes_nothing(spark, intake, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_csv(raw / "teams_1.csv", "teams", [team("T1"), team("T2", name=None)])
    write_csv(raw / "players_1.csv", "players", [player("P1"), player("P2", "T7"), player("P3", name=None)])
    run(spark, intake, tmp_path, "teams")
    real = Intake.deliver

    def dies(self, delivered, number):
        real(self, delivered, number)
        raise RuntimeError("lost")

    monkeypatch.setattr(Intake, "deliver", dies)
    with pytest.raises(Exception, match="lost"):
        run(spark, intake, tmp_path, "players")
    once = {t: rows(intake.warehouse.read(t)) for t in ("dim_players", "dim_players_quarantine", waiting_table("players"))}
    monkeypatch.setattr(Intake, "deliver", real)
    run(spark, intake, tmp_path, "players")
    assert {t: rows(intake.warehouse.read(t)) for t in once} == once
    assert all(len(r) == 1 for r in once.values())


def test_landed_batches_that_come_again_land_once(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "matches_1.json").write_text(json.dumps([match("M1"), "odd"]))

    def start():
        stream_to_landing(spark, "matches", str(raw), str(tmp_path / "landing"), str(tmp_path / "checkpoint")).awaitTermination()

    real = landing._stream

    def dying(*args):
        def take(read, number):
            args[-1](read, number)
            raise RuntimeError("lost")
        return real(*args[:-1], take)

    monkeypatch.setattr(landing, "_stream", dying)
    with pytest.raises(Exception, match="lost"):
        start()
    monkeypatch.setattr(landing, "_stream", real)
    start()
    start()
    landed = spark.read.parquet(str(tmp_path / "landing" / "matches.parquet"))
    assert landed.count() == 1 and DELIVERY in landed.columns
    assert [r._text for r in odd(spark, tmp_path / "landing" / "_quarantine" / "matches")] == ["odd"]
