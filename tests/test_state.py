"""Counts and totals that add up over deliveries."""

import math
import random

import pytest
from pyspark.sql import functions as F

from statline.operators import split_contract
from statline.plans.marts import player_season
from statline.plans.quality import check_all, quality_report, quality_summary, quality_warnings
from statline.plans.quality_state import QualityLog, state_report, state_summary, state_warnings
from statline.plans.season import SeasonTotals, joined, limbs
from statline.schemas import DATASETS
from statline.sources import Warehouse
from tests.conftest import event, match, player, stats, team


def rows(df, *columns):
    return sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())


def test_states_of_deliveries_give_the_report_of_all_rows(spark, make, tmp_path):
    first = {
        "teams": [team("T1"), team("T1"), team("T2", city=None)],
        "players": [player("P1", "T3"), player("P2", position=None, date_of_birth="03/04/1990", market_value=-2.0), player("P3", None)],
        "matches": [match("M1", match_date="1/2/2024"), match("M2", attendance=None)],
        "player_match_stats": [stats("P1", "M1", goals=None), stats("P9", "M1"), stats(None, "M1"), stats("P2", "M9", yellow_cards=5)],
    }
    second = {
        "teams": [team("T3")],
        "players": [player("P1"), player("P4", market_value=None)],
        "player_match_stats": [stats("P9", "M1"), stats("P4", "M2", shots=1, shots_on_target=2)],
        "match_events": [event("E1"), event("E1", player_id="P7"), event("E2", event_type="pass", x_end=None)],
    }
    log = QualityLog(Warehouse(spark, str(tmp_path)))
    assert log.total().count() == 0 and state_summary(log.total()).filter("total_rows = 0").count() == 5
    log.add("1", {n: make(n, r) for n, r in first.items()})
    assert state_warnings(log.total()).filter("check = 'orphan' and column = 'team_id' and dataset = 'players'").first().n_keys == 1
    for _ in range(2):  # a delivery that comes again counts once
        log.add("2", {n: make(n, r) for n, r in second.items()})
    whole = check_all({n: make(n, first.get(n, []) + second.get(n, [])) for n in DATASETS})
    state = log.total()
    size = ("dataset", "total_rows", "valid_rows", "invalid_rows", "valid_percentage")
    assert rows(state_summary(state), *size) == rows(quality_summary(whole), *size)
    found = ("dataset", "check", "column", "n_keys", "n_rows")
    assert rows(state_warnings(state), *found) == rows(quality_warnings(whole), *found)
    report = ("dataset", "section", "item", "detail")
    assert rows(state_report(state), *report) == rows(quality_report(whole), *report)
    # The parent that came later is known now.
    assert state_warnings(state).filter("check = 'orphan' and column = 'team_id' and dataset = 'players'").isEmpty()


def random_stats(rnd, n):
    found = {}
    for _ in range(n):
        key = (f"P{rnd.randrange(12)}", f"M{rnd.randrange(9)}")
        goals = rnd.randrange(4)
        found[key] = stats(*key, goals=goals, minutes_played=rnd.randrange(91), shots=rnd.randrange(9),
                           xg=rnd.choice([None, rnd.random() * 5, 1e-4]), xa=rnd.choice([None, 0.1, rnd.random()]))
    return list(found.values())


def conformed(make, found):
    df = make("player_match_stats", found).drop("_seq")
    df = df.withColumns({"goal_contribution": F.col("goals") + F.col("assists"), "g_xg": F.col("goals") - F.col("xg")})
    return split_contract(df, DATASETS["player_match_stats"].mart_schema)[0]


def close(a, b):
    return all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12))
               for x, y in zip(a, b))


def test_signed_changes_equal_a_full_build(spark, make, tmp_path, monkeypatch):
    rnd = random.Random(5)
    season, known = SeasonTotals(spark, str(tmp_path / "season"), 4), {}
    for step, n in enumerate((60, 8, 3)):
        delivery = random_stats(rnd, n)
        if step == 2:  # the job dies between its two tables, and the next one finishes it
            with monkeypatch.context() as m:
                m.setattr(season.totals, "merge", lambda df: (_ for _ in ()).throw(RuntimeError("lost")))
                with pytest.raises(RuntimeError):
                    season.apply(conformed(make, delivery))
            season = SeasonTotals(spark, str(tmp_path / "season"))
        else:
            changed = season.apply(conformed(make, delivery))
            assert changed <= len({r["player_id"] for r in delivery})
        known |= {(r["player_id"], r["match_id"]): r for r in delivery}
        full = {r.player_id: tuple(r) for r in player_season(conformed(make, list(known.values()))).collect()}
        kept = {r.player_id: tuple(r) for r in season.season().collect()}
        assert full.keys() == kept.keys() and all(close(full[p], kept[p]) for p in full)
    assert season.apply(conformed(make, [known[min(known)]])) == 0  # nothing new: no player changes


def test_limbs_add_up_in_any_order(spark):
    rnd = random.Random(1)
    values = [rnd.choice([1e-7, 0.1, 33.3, -2.5, 1e9]) * rnd.random() for _ in range(500)]
    df = spark.createDataFrame([(float(v),) for v in values], "x float").repartition(7)
    exact = math.fsum(r.x for r in df.collect())
    for n in (1, 5):
        whole, rest = limbs(F.col("x"))
        sums = df.repartition(n).agg(F.sum(whole).alias("w"), F.sum(rest).alias("r"))
        assert abs(sums.select(joined(F.col("w"), F.col("r"))).first()[0] - exact) <= 1e-9 * abs(exact)
        assert len({tuple(r) for r in sums.collect()}) == 1
