"""Large documents over many tasks, quoted line breaks, the manifest of taken files."""

import datetime as dt
import json
import os
import random

import pyarrow as pa
import pytest

from statline.functions import json_rows
from statline.schemas import SEQ
from statline.sources import Warehouse, confirm, ingest_raw, load_from_landing, read_mark
from statline.sources.json_blocks import block_states, elements
from statline.sources.state import read_manifest
from tests.conftest import match, player, team
from tests.test_sources import write_csv


@pytest.fixture
def blocks(spark):
    """``blocks(n)``: files are read in blocks of n bytes until the test ends."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield use
    for name, value in zip(names, before):
        spark.conf.set(name, value)


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "raw").mkdir()
    return tmp_path / "raw", tmp_path / "landing"


def value(rnd, depth=0):
    kind = rnd.randrange(7 if depth < 2 else 4)
    if kind == 4:
        return [value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]
    if kind > 4:
        return {rnd.choice("abc"): value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))}
    text = "".join(rnd.choice('ab}{[]",\\ \n{}é') for _ in range(rnd.randint(0, 12)))
    return (rnd.randint(-9, 99), text, None, rnd.choice([True, 1.5, "x"]))[kind]


SOUND = {'[{"a":1} {"b":2},{"a":3}]': ['{"a":1} {"b":2}', '{"a":3}'], '[{"a":1}] x': ['{"a":1}', "x"], "[]": [], " [ ]\n": [],
         ' [1,,{"a":2},]': ["1", "", '{"a":2}', ""], "5": ["5"], '{"a":1}{"b":2}': ['{"a":1}{"b":2}'], '[{"a":1}}': ['{"a":1}', "}"]}
BROKEN = ['[{"a": 1}, {"b"', '{"a":1', '[{"a":1}]}', '[{"a":"1}]', "[", '["}']


@pytest.mark.parametrize("size", [61, 300, 100_000])
def test_elements_whatever_the_blocks(spark, tmp_path, blocks, size):
    blocks(size)
    rnd = random.Random(size)
    docs = {}
    for i in range(24):
        doc = ([value(rnd) for _ in range(rnd.randint(0, 30))] if i % 3 == 0 else
               [{"a": rnd.randint(0, 99), "b": rnd.choice(["x", "}", '"q\\', None])} for _ in range(rnd.randint(0, 40))] if i % 3 == 1
               else {"a": value(rnd), "b": [value(rnd), value(rnd)]})
        text = json.dumps(doc, indent=rnd.choice([None, 1]), ensure_ascii=bool(i % 2))
        (tmp_path / f"d{i}.json").write_text(" \n" * (i % 2) + text + "\n" * (i % 5 == 0))
        docs[f"d{i}.json"] = doc if isinstance(doc, list) else [doc]
    for i, text in enumerate([*SOUND, *BROKEN]):
        (tmp_path / f"t{i}.json").write_text(text)
    block_states(spark, str(tmp_path)).write.parquet(str(tmp_path / "_states"))
    states = spark.read.parquet(str(tmp_path / "_states"))
    broken = {os.path.basename(r.file) for r in states.filter("broken").collect()}
    assert broken == {f"t{i}.json" for i in range(len(SOUND), len(SOUND) + len(BROKEN))}
    found = {}
    for r in elements(spark, str(tmp_path), states).orderBy("file", "block", "place").collect():
        found.setdefault(os.path.basename(r.file), []).append(r.text)
    assert {n: [json.loads(t) for t in found.get(n, [])] for n in docs} == docs
    assert [found.get(f"t{i}.json", []) for i in range(len(SOUND))] == list(SOUND.values())
    if size == 61:
        assert states.count() > 3 * len(docs)


def test_one_large_document_lands_by_many_tasks(spark, folders, blocks, tmp_path):
    raw, landing = folders
    rows = [match(f"M{i}", referee='a "}" \\') if i % 7 else 7 for i in range(4_000)]
    (raw / "matches.json").write_text(json.dumps(rows))
    blocks(50_000)
    assert ingest_raw(spark, str(raw), str(landing), Warehouse(spark, str(tmp_path / "wh"))) == ["matches"]
    states = spark.read.parquet(f"{landing}/_incoming/_blocks-matches")
    assert states.count() > 10
    loaded = load_from_landing(spark, str(landing))["matches"].orderBy(SEQ).collect()
    assert [r.match_id for r in loaded] == [r["match_id"] for r in rows if r != 7]
    assert {r.referee for r in loaded} == {'a "}" \\'}
    assert spark.read.parquet(f"{landing}/_quarantine/matches").filter("_text = '7'").count() == rows.count(7)


def test_a_repaired_delivery_clears_the_quarantine(spark, folders, tmp_path):
    raw, landing = folders
    house = Warehouse(spark, str(tmp_path / "wh"))
    (raw / "matches.json").write_text(json.dumps([match("M1"), 5]))
    (raw / "teams.csv").write_text("team_id,name,league,stadium,city\nT1,a,b,c\nT2,a,b,c,d\n")
    (raw / "other.csv").write_text("a,b\n1,2\n3,4,5\n6\n")
    ingest_raw(spark, str(raw), str(landing), house)
    kept = {n: spark.read.parquet(f"{landing}/_quarantine/{n}").count() for n in ("matches", "teams", "other")}
    assert kept == {"matches": 1, "teams": 1, "other": 2}
    assert [tuple(r) for r in spark.read.parquet(f"{landing}/other.parquet").collect()] == [(1, 2)]
    (raw / "matches.json").write_text(json.dumps([match("M1")]))
    (raw / "teams.csv").write_text("team_id,name,league,stadium,city\nT1,a,b,c,d\n")
    (raw / "other.csv").write_text("a,b\n1,2\n")
    ingest_raw(spark, str(raw), str(landing), house, force=True)
    assert not any((landing / "_quarantine" / n).exists() for n in ("matches", "teams", "other"))


def test_line_breaks_in_quoted_fields(spark, folders, tmp_path):
    raw, landing = folders
    (raw / "teams.csv").write_text('team_id,name,league,stadium,city\nT1,A,L,S,"New\nYork"\nT2,"A ""b""\nc",L,S,C\n')
    (raw / "notes.csv").write_text('a,b\n1,"x\ny"\n')
    assert ingest_raw(spark, str(raw), str(landing), Warehouse(spark, str(tmp_path / "wh"))) == ["notes", "teams"]
    rows = {r.team_id: (r["name"], r.city) for r in spark.read.parquet(f"{landing}/teams.parquet").collect()}
    assert rows == {"T1": ("A", "New\nYork"), "T2": ('A "b"\nc', "C")}
    assert spark.read.parquet(f"{landing}/notes.parquet").first().b == "x\ny"
    assert not (landing / "_quarantine").exists()


def test_manifest_takes_each_file_once(spark, folders, tmp_path):
    raw, landing = folders
    house = Warehouse(spark, str(tmp_path / "wh"))

    def take(**options):
        return ingest_raw(spark, str(raw), str(landing), house, by="manifest", **options)

    def names():
        return sorted(r["name"] for r in load_from_landing(spark, str(landing))["players"].collect())

    (raw / "players.csv").mkdir()
    write_csv(raw / "players.csv" / "a.csv", "players", [player("P1", name="one")])
    write_csv(raw / "teams.csv", "teams", [team("T1")])
    (raw / "matches.json").write_text("{broken")
    assert take() == ["players", "teams"] and read_manifest(house).count() == 3
    assert take() == []  # though all files are of this very day
    late = raw / "players.csv" / "b.csv"
    write_csv(late, "players", [player("P2", name="two")])
    old = dt.datetime(2001, 1, 1).timestamp()
    os.utime(late, (old, old))  # copied in with an old time
    assert take(confirmed=False) == ["players"] and names() == ["two"]
    assert take() == ["players"] and take() == []  # not remembered before it was confirmed
    write_csv(raw / "players.csv" / "a.csv", "players", [player("P1", name="changed")])
    assert take() == ["players"] and names() == ["changed"]
    confirm(spark, str(landing), house)
    assert take(force=True) == ["players", "teams"] and names() == ["changed", "two"]
    assert read_manifest(house).count() == 4 and read_mark(house) == dt.date(1900, 1, 1)
    with pytest.raises(ValueError):
        ingest_raw(spark, str(raw), str(landing), house, by="hour")


def test_json_rows_lose_no_neighbour_of_an_odd_element(spark):
    cells = spark.createDataFrame([(1, '[{"a":1},{"a":2},5]'), (2, '[{"a":3}]'), (3, "no"), (4, None), (5, '["x", [1]]')], "k int, j string")
    from pyspark.sql import types as T
    found = json_rows(cells, "j", T.StructType([T.StructField("a", T.LongType())]))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (1, 2), (2, 3)]


def test_pyarrow_strings_stay_whole():
    from statline.sources.json_blocks import _structure, _unescaped
    import numpy as np
    values = pa.array(['a"b\\"{"[', '{x"[', "]"])
    assert _structure(_unescaped(values), np.array([False, True, True])).to_pylist() == ["a[", "[", ""]
