import datetime as dt
import json
import os

import pytest

from statline.plans.clean import clean_teams
from statline.plans.reports import clean_and_save, run, store_player_view
from statline.schemas import DATASETS, SEQ
from statline.sources import (
    ContractError, Warehouse, advance_mark, ingest_raw, list_sources, load_from_landing, read_mark, write_report,
)
from statline.streaming import stream_to_landing
from tests.conftest import event, match, player, stats, team


@pytest.fixture
def place(spark, tmp_path):
    """Folders of one run, and the warehouse in them."""
    (tmp_path / "raw").mkdir()
    return tmp_path, Warehouse(spark, str(tmp_path / "wh"))


def ingest(spark, place, **options):
    root, warehouse = place
    return ingest_raw(spark, str(root / "raw"), str(root / "landing"), warehouse, **options)


def write_csv(path, dataset, rows):
    names = list(DATASETS[dataset].raw)
    lines = [",".join(names)]
    lines += [",".join("" if r.get(n) is None else str(r[n]) for n in names) for r in rows]
    path.write_text("\n".join(lines) + "\n")


def landed(root):
    folder = root / "landing"
    return sorted(p.name for p in folder.iterdir() if not p.name.startswith(("_", "."))) if folder.exists() else []


def test_unknown_csv_lands_with_inferred_types(spark, place):
    root, _ = place
    (root / "raw" / "scores.csv").write_text("a,b\n1,x\n3,y\n")
    assert ingest(spark, place) == ["scores"]
    assert spark.read.parquet(str(root / "landing/scores.parquet")).dtypes == [("a", "int"), ("b", "string")]


def test_unknown_json_lands_as_one_cell_per_document(spark, place):
    root, _ = place
    (root / "raw" / "note.json").write_text('{"id": 1,\n "name": "x"}')
    assert ingest(spark, place) == ["note"]
    row = spark.read.parquet(str(root / "landing/note.parquet")).first()
    assert row.file.endswith("raw/note.json") and json.loads(row.data) == {"id": 1, "name": "x"}


def test_unreadable_sources_do_not_land(spark, place):
    root, warehouse = place
    raw = root / "raw"
    (raw / "bad.json").write_text("{no json}")
    (raw / "cut.json").write_text('[{"a": 1}, {"b"')
    (raw / "two.json").write_text('{"a": 1}{"b": 2}')
    (raw / "empty.json").write_text("")
    (raw / "empty.csv").write_text("")
    (raw / "header.csv").write_text("a,b\n")
    (raw / "plain.txt").write_text("text")
    (raw / "deep").mkdir()
    (raw / "deep" / "inner.csv").write_text("a\n1\n")
    assert ingest(spark, place) == [] and landed(root) == []
    assert read_mark(warehouse) == dt.date(1900, 1, 1)
    quarantine = spark.read.parquet(str(root / "landing/_quarantine/bad"))
    assert quarantine.first().file.endswith("bad.json")


def test_missing_raw_folder(spark, tmp_path):
    assert ingest_raw(spark, str(tmp_path / "none"), str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "w"))) == []


def test_only_changed_sources_are_taken_again(spark, place):
    root, warehouse = place
    write_csv(root / "raw" / "teams.csv", "teams", [team("T1")])
    write_csv(root / "raw" / "players.csv", "players", [player("P1")])
    old = dt.datetime(2020, 5, 1, 12).timestamp()
    os.utime(root / "raw" / "teams.csv", (old, old))
    assert ingest(spark, place, today=dt.date(2020, 5, 1)) == ["players", "teams"]
    assert read_mark(warehouse) == dt.date(2020, 5, 1)
    # The day itself counts, the day before does not; force takes all.
    assert ingest(spark, place, today=dt.date(2020, 5, 2)) == ["players", "teams"]
    assert ingest(spark, place, today=dt.date(2020, 5, 3)) == ["players"]
    assert ingest(spark, place, force=True) == ["players", "teams"]


def test_sources_are_listed_by_name(spark, place):
    root, _ = place
    for name in ("b.csv", "a.json", "c.CSV", "e.x.csv", ".csv"):
        (root / "raw" / name).write_text("a\n1\n")
    (root / "raw" / "d.csv").mkdir()
    (root / "raw" / "d.csv" / "part-0.csv").write_text("a\n1\n")
    found = list_sources(spark, str(root / "raw"))
    assert [(s.name, s.suffix, s.size) for s in found] == [("a", "json", 4), ("b", "csv", 4), ("d", "csv", 4), ("e.x", "csv", 4)]


def test_known_csv_keeps_text_and_order(spark, place):
    root, _ = place
    write_csv(root / "raw" / "players.csv", "players", [player(f"P{i % 3}", name=f"n{i}", market_value="x") for i in range(300)])
    ingest(spark, place)
    rows = load_from_landing(spark, str(root / "landing"))["players"].orderBy(SEQ).collect()
    assert [r["name"] for r in rows] == [f"n{i}" for i in range(300)]
    assert {r.market_value for r in rows} == {"x"}


def test_part_files_of_one_source_must_agree(spark, place):
    root, _ = place
    folder = root / "raw" / "teams.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("team_id,name,league,stadium,city\nT1,a,b,c,d\n")
    (folder / "b.csv").write_text("name,team_id,league,stadium,city\na,T2,b,c,d\n")
    assert ingest(spark, place) == [] and landed(root) == []


def test_landing_load(spark, place):
    root, _ = place
    write_csv(root / "raw" / "teams.csv", "teams", [team("T1"), team("T2", city=None)])
    (root / "raw" / "matches.json").write_text(json.dumps([match("M1"), match("M2", attendance=None)]))
    ingest(spark, place)
    loaded = load_from_landing(spark, str(root / "landing"))
    assert set(loaded) == set(DATASETS)
    assert loaded["players"].isEmpty() and loaded["match_events"].isEmpty()
    rows = {r.match_id: r for r in loaded["matches"].collect()}
    assert (rows["M1"].attendance, rows["M2"].attendance, rows["M2"][SEQ].record) == ("500", None, 1)


def test_landed_documents_are_expanded(spark, place):
    root, _ = place
    cells = spark.createDataFrame([("matches.json", '[{"match_id":"M1","competition":"Cup"},{"match_id":"M2"}]')],
                                  "file string, data string")
    cells.write.parquet(str(root / "landing/matches.parquet"))
    rows = load_from_landing(spark, str(root / "landing"))["matches"].orderBy(SEQ).collect()
    assert [(r.match_id, r.competition) for r in rows] == [("M1", "Cup"), ("M2", None)]


def test_tables_landed_by_other_means_get_a_position(spark, place):
    root, _ = place
    rows = spark.createDataFrame([(f"T{i % 2}", f"n{i}") for i in range(20)], "team_id string, name string").coalesce(1)
    rows.write.parquet(str(root / "landing/teams.parquet"))
    loaded = load_from_landing(spark, str(root / "landing"))["teams"]
    assert {r.team_id: r["name"] for r in clean_teams(loaded).collect()} == {"T0": "n18", "T1": "n19"}


def test_mark(place):
    _, warehouse = place
    assert read_mark(warehouse) == dt.date(1900, 1, 1)
    advance_mark(warehouse, dt.date(2024, 3, 1))
    assert read_mark(warehouse) == dt.date(2024, 3, 1)


def teams_frame(spark, *rows):
    return spark.createDataFrame(rows, "team_id string, name string, league string, stadium string, city string")


def test_save_upserts_by_key(spark, place):
    _, warehouse = place
    warehouse.save("teams", teams_frame(spark, ("T1", "a", "l", "s", "c"), ("T2", "b", "l", "s", "c")))
    warehouse.save("teams", teams_frame(spark, ("T2", "new", "l", "s", "c"), ("T3", "d", "l", "s", "c")))
    rows = {r.team_id: r.name for r in warehouse.read("dim_teams").collect()}
    assert rows == {"T1": "a", "T2": "new", "T3": "d"}


def test_save_guards_the_contract(spark, place):
    _, warehouse = place
    assert warehouse.save("teams", teams_frame(spark)) is None
    saved = warehouse.save("teams", teams_frame(spark, ("T1", "a", "l", "s", "c"), ("T2", None, "l", "s", "c")))
    assert [r.team_id for r in saved.collect()] == ["T1"]
    assert [r.team_id for r in warehouse.read("dim_teams_quarantine").collect()] == ["T2"]
    with pytest.raises(ContractError):
        warehouse.save("teams", teams_frame(spark, ("T4", "a", "l", "s", "c"), ("T4", "b", "l", "s", "c"),
                                            ("T5", None, "l", "s", "c")))
    assert [r.team_id for r in warehouse.read("dim_teams").collect()] == ["T1"]
    assert [r.team_id for r in warehouse.read("dim_teams_quarantine").collect()] == ["T2"]


def test_incomplete_version_is_not_read(spark, place):
    root, warehouse = place
    warehouse.save("teams", teams_frame(spark, ("T1", "a", "l", "s", "c")))
    half = root / "wh" / "dim_teams" / "version=00000002"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half")
    assert warehouse.read("dim_teams").count() == 1
    warehouse.save("teams", teams_frame(spark, ("T2", "b", "l", "s", "c")))
    assert warehouse.read("dim_teams").count() == 2


def test_csv_report(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", None)], "k string, v int").orderBy("k")
    path = write_report(df, str(tmp_path), "list", dt.datetime(2024, 5, 6, 7, 8, 9, 10))
    assert path.endswith("/list_20240506070809000010")
    assert [tuple(r) for r in spark.read.option("header", True).csv(path).collect()] == [("a", "1"), ("b", "2"), ("c", None)]


def season(raw):
    write_csv(raw / "teams.csv", "teams", [team("T1"), team("T2"), team("T1", name="Renamed")])
    write_csv(raw / "players.csv", "players", [player("P1"), player("P2", "T2", position="gk"), player("P3", "T9")])
    (raw / "matches.json").write_text(json.dumps([match("M1"), match("M2", match_date="25/02/2024")]))
    write_csv(raw / "player_match_stats.csv", "player_match_stats", [
        stats("P1", "M1", minutes_played=90, goals=2, shots=4, xg=0.5), stats("P1", "M2", minutes_played=90, xg=-1),
        stats("P2", "M1", minutes_played=90), stats("P3", "M1", minutes_played=90)])
    (raw / "match_events.json").write_text(json.dumps([event("E1"), event("E2", match_id="M9"), event("E1", minute=7)]))


@pytest.mark.parametrize("form", ["dataframe", "sql"])
def test_raw_files_to_reports(spark, place, form):
    root, warehouse = place
    season(root / "raw")
    folders = [str(root / n) for n in ("raw", "landing", "wh", "reports")]
    paths = run(spark, *folders, as_of=dt.date(2024, 1, 1), form=form, team_ids=["T1"])
    assert len(paths) == 8
    view = {r.player_id: r for r in warehouse.read("agg_player_stats").collect()}
    assert set(view) == {"P1", "P2"}
    assert (view["P1"].team_name, view["P1"].goals, view["P1"].g_xg, view["P1"].goals_90) == ("Renamed", 2, 1.5, 1.0)
    assert [(r.event_id, r.minute) for r in warehouse.read("fact_match_events").collect()] == [("E1", 7)]
    report = spark.read.option("header", True).csv(next(p for p in paths if "validation_report" in p))
    assert report.filter("section = 'rows'").count() == 5
    listed = spark.read.option("header", True).csv(next(p for p in paths if "team_top3_T1" in p))
    assert [r.player_name for r in listed.collect()] == ["Player P1"]
    # A second run over the same landing changes nothing.
    before = sorted(map(tuple, warehouse.read("fact_player_match_stats").collect()))
    clean_and_save(spark, folders[1], warehouse, dt.date(2024, 1, 1))
    assert sorted(map(tuple, warehouse.read("fact_player_match_stats").collect())) == before


def test_view_needs_stored_tables(place):
    with pytest.raises(ValueError):
        store_player_view(place[1])


def stream(spark, root, dataset):
    query = stream_to_landing(spark, dataset, str(root / "raw"), str(root / "landing"), str(root / "checkpoint"))
    query.awaitTermination()
    return load_from_landing(spark, str(root / "landing"))[dataset]


def test_stream_lands_each_csv_file_once(spark, place):
    root, _ = place
    write_csv(root / "raw" / "players_1.csv", "players", [player(f"P{i}", name=f"n{i}") for i in range(50)])
    write_csv(root / "raw" / "teams_1.csv", "teams", [team("T1")])
    first = stream(spark, root, "players").orderBy(SEQ)
    assert [r["name"] for r in first.collect()] == [f"n{i}" for i in range(50)]
    write_csv(root / "raw" / "players_2.csv", "players", [player("P1", name="later")])
    assert stream(spark, root, "players").count() == 51
    again = stream(spark, root, "players")
    assert again.count() == 51
    assert again.orderBy(again[SEQ].desc()).first()["name"] == "later"


def test_stream_lands_json_documents(spark, place):
    root, _ = place
    (root / "raw" / "matches_1.json").write_text(json.dumps([match("M1"), match("M2")]))
    (root / "raw" / "matches_2.json").write_text("{no json}")
    rows = stream(spark, root, "matches").orderBy(SEQ).collect()
    assert [(r.match_id, r.home_score) for r in rows] == [("M1", "2"), ("M2", "2")]


def test_one_odd_element_costs_only_itself(spark, tmp_path):
    raw, landing = tmp_path / "raw", tmp_path / "landing"
    raw.mkdir()
    (raw / "matches.json").write_text(json.dumps([match("M1"), 7, match("M2"), {"other": 1}]))
    assert ingest_raw(spark, str(raw), str(landing), Warehouse(spark, str(tmp_path / "house"))) == ["matches"]
    assert {r.match_id for r in spark.read.parquet(f"{landing}/matches.parquet").collect()} == {"M1", "M2"}
    kept = spark.read.parquet(f"{landing}/_quarantine/matches").collect()
    assert sorted((r._place, r._text) for r in kept) == [(1, "7"), (3, '{"other":1}')]


def test_rows_without_a_record_do_not_replace_landed_ones(spark, tmp_path):
    raw, landing, house = tmp_path / "raw", tmp_path / "landing", Warehouse(spark, str(tmp_path / "house"))
    raw.mkdir()
    (raw / "matches.json").write_text(json.dumps([match("M1")]))
    ingest_raw(spark, str(raw), str(landing), house)
    (raw / "matches.json").write_text(json.dumps({"matches": [match("M2")]}))
    assert ingest_raw(spark, str(raw), str(landing), house, force=True) == []
    assert [r.match_id for r in spark.read.parquet(f"{landing}/matches.parquet").collect()] == ["M1"]


def test_csv_quotes_odd_rows_and_nested_parts(spark, tmp_path):
    raw, landing = tmp_path / "raw", tmp_path / "landing"
    (raw / "teams.csv" / "day=1").mkdir(parents=True)
    (raw / "teams.csv" / "day=1" / "p.csv").write_text(
        'team_id,name,league,stadium,city\nT1,"The ""Reds"" FC",First,Ground,Town\nT2,Blues,First,Ground,Town,extra\n'
        "T3,Short,First\nT4,Greens,First,Ground,Town\n")
    assert ingest_raw(spark, str(raw), str(landing), Warehouse(spark, str(tmp_path / "house"))) == ["teams"]
    rows = {r.team_id: r["name"] for r in spark.read.parquet(f"{landing}/teams.parquet").collect()}
    assert rows == {"T1": 'The "Reds" FC', "T4": "Greens"}
    broken = spark.read.parquet(f"{landing}/_quarantine/teams").collect()
    assert {r.team_id for r in broken} == {"T2", "T3"} and all(r._corrupt_record for r in broken)


def test_reports_double_their_quotes(spark, tmp_path):
    path = write_report(spark.createDataFrame([('a "q" b',)], "x string").coalesce(1), str(tmp_path), "r")
    text = "".join(p.read_text() for p in (tmp_path / path.rsplit("/", 1)[1]).glob("part-*"))
    assert '"a ""q"" b"' in text
