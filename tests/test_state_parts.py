"""States are counted and added kind by kind; a table's partitions are moved, not written twice."""

from pyspark.sql import functions as F

from statline.plans.quality_state import GROUP, added, dataset_state
from statline.sources import KeyedTable, files
from tests.conftest import player, stats


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_states_add_up_and_explode_no_row(make):
    raw = make("player_match_stats", [stats("P1", "M1"), stats("P1", "M1", goals=-1), stats(None, "M2", goals=-1), stats(None, "M2")])
    state = dataset_state("player_match_stats", raw)
    assert "explode" not in plan(state)
    one = {tuple(r)[:5]: r.n for r in state.collect()}
    assert one["player_match_stats", "key", "player_id-match_id", "P1\x1fM1", None] == 2
    assert one["player_match_stats", "rows", "", "valid", None] == 1 and one["player_match_stats", "rows", "", "invalid", None] == 3
    twice = added([state, state])
    assert {tuple(r)[:5]: r.n for r in twice.collect()} == {k: 2 * n for k, n in one.items()}
    assert twice.groupBy(*GROUP).count().filter("count > 1").isEmpty()


def test_no_row_counts_as_zero(make):
    state = dataset_state("players", make("players", [player("P1")]).limit(0))
    assert sorted((r.kind, r.column, r.item, r.n) for r in state.collect() if r.kind == "null") == [
        ("null", "contract_until", None, 0), ("null", "market_value", None, 0)]
    assert {r.item: r.n for r in state.filter("kind = 'rows'").collect()} == {"valid": 0, "invalid": 0}


def test_merged_partitions_are_moved(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], 4)
    rows = spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    table.merge(rows)
    written = []
    write = KeyedTable._write
    monkeypatch.setattr(KeyedTable, "_write", lambda self, *a, **b: (written.append(a[1]), write(self, *a, **b)))
    table.merge(rows.filter("k < 20").withColumn("v", F.lit("new")))
    assert len(written) == 1 and written[0].endswith("_pending")
    assert {r.v: r["count"] for r in table.read().groupBy("v").count().collect()} == {"new": 20, "old": 20}


def test_a_job_that_dies_among_moves_is_finished(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], 4)
    rows = spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    table.merge(rows)
    move, moved = files.move, []

    def dies(*names):
        if moved:
            raise RuntimeError("lost")
        moved.append(names)
        move(*names)

    with monkeypatch.context() as m:
        m.setattr(files, "move", dies)
        try:
            table.merge(rows.withColumn("v", F.lit("new")))
        except RuntimeError:
            pass
    assert len(moved) == 1
    again = KeyedTable(spark, str(tmp_path / "t"), ["k"], 4).read()
    assert again.count() == 40 and {r.v for r in again.collect()} == {"new"}
