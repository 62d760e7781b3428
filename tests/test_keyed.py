"""Upserts that touch only the partitions they hit."""

import random

import pytest
from pyspark.sql import functions as F

from statline.operators import upsert
from statline.sources import KeyedTable, Warehouse, files
from statline.sources.keyed import BUCKET, bucket_of


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, part string, v string")


def content(df):
    return sorted((r.k, r.part or "", r.v) for r in df.collect())


def stamps(path):
    return {p.parent.name: p.stat().st_mtime_ns for p in path.rglob(f"{BUCKET}=*/*.parquet")}


@pytest.mark.parametrize("key", [["k"], ["k", "part"]])
def test_deliveries_equal_plain_upserts(spark, tmp_path, key):
    rnd = random.Random(len(key))
    table, plain = KeyedTable(spark, str(tmp_path / "t"), key, 16), None
    assert table.read() is None
    for n in (200, 3, 0, 40):
        rows = {k: (k, "p" if len(key) == 1 else rnd.choice(["a", "b", None]), str(rnd.random())) for k in rnd.sample(range(400), n)}
        delivery = frame(spark, list(rows.values()))
        before = stamps(tmp_path)
        merge = table.merge(delivery)
        if plain is None:
            plain = delivery
        else:  # a key with a null part meets no other, as in any join
            keys = {k for r in delivery.collect() if None not in (k := tuple(r[c] for c in key))}
            plain = frame(spark, [r for r in map(tuple, plain.collect()) if (r[0], r[1])[:len(key)] not in keys] + list(rows.values()))
        assert content(table.read()) == content(plain)
        hit = {r[0] for r in delivery.select(bucket_of(key, 16)).collect()}
        assert set(merge.buckets) == hit
        assert merge.rows_written == plain.filter(bucket_of(key, 16).isin(list(hit))).count()
        after = stamps(tmp_path)
        assert {b for b in after if after[b] != before.get(b)} == {f"{BUCKET}={b}" for b in hit}


def test_one_percent_writes_only_its_partitions(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], 512)
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.lit("p").alias("part"), F.lit("old").alias("v"))
    table.merge(rows)
    some = rows.filter(F.pmod(F.crc32(F.col("k").cast("string")), F.lit(512)) < 5).withColumn("v", F.lit("new"))
    assert 100 < some.count() < 300
    merge = table.merge(some)
    assert len(merge.buckets) == 5 and merge.rows_written == some.count()
    assert {r.v: r["count"] for r in table.read().groupBy("v").count().collect()} == {"new": some.count(), "old": 20_000 - some.count()}
    scan = table.part([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "_bucket" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_job_that_dies_is_finished_or_forgotten(spark, tmp_path, monkeypatch):
    path = tmp_path / "t"
    table = KeyedTable(spark, str(path), ["k"], 8)
    table.merge(frame(spark, [(i, "p", "old") for i in range(50)]))

    def dies(self, pending):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_put", dies)
        with pytest.raises(RuntimeError):
            table.merge(frame(spark, [(1, "p", "new"), (70, "p", "new")]))
    assert {r.v for r in table.read().collect()} == {"old"}  # complete, but not put yet
    again = KeyedTable(spark, str(path), ["k"], 999)
    assert again.buckets == 8
    assert sorted(r.k for r in again.read().filter("v = 'new'").collect()) == [1, 70] and again.read().count() == 51
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_put", dies)
        with pytest.raises(RuntimeError):
            table.merge(frame(spark, [(2, "p", "half")]))
    files.remove(spark, f"{path}/buckets=8/_pending/_SUCCESS")  # as if it had died while writing
    assert KeyedTable(spark, str(path), ["k"], 8).read().filter("v = 'half'").count() == 0


def test_warehouse_saves_by_partition(spark, tmp_path):
    schema = "team_id string, name string, league string, stadium string, city string"

    def teams(*rows):
        return spark.createDataFrame([(k, n, "l", "s", "c") for k, n in rows], schema)

    plain, house = Warehouse(spark, str(tmp_path / "a")), Warehouse(spark, str(tmp_path / "b"), buckets=32)
    Warehouse(spark, str(tmp_path / "b")).save("teams", teams(*((f"T{i}", "first") for i in range(40))))  # moves over
    plain.save("teams", teams(*((f"T{i}", "first") for i in range(40))))
    for rows in ([("T1", "x"), ("T99", "y")], [("T99", "z"), ("T2", None)], []):
        for each in (plain, house):
            each.save("teams", teams(*rows))
        assert sorted(map(tuple, house.read("dim_teams").collect())) == sorted(map(tuple, plain.read("dim_teams").collect()))
    assert house.read("dim_teams").columns == plain.read("dim_teams").columns
    # Once a table lies in partitions it stays so, whoever opens the warehouse.
    late = Warehouse(spark, str(tmp_path / "b"))
    late.save("teams", teams(("T1", "later")))
    assert late.read("dim_teams").filter("name = 'later'").count() == 1 and late.read("dim_teams").count() == 41
    assert [r.team_id for r in house.read("dim_teams_quarantine").collect()] == ["T2"]


def test_plain_upsert_keeps_columns(spark):
    assert upsert(frame(spark, [(1, "a", "b")]), frame(spark, [(1, "c", "d")]), ["k"]).collect()[0].v == "d"
