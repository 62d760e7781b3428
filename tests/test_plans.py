"""Physical plans: what is shuffled, what is pushed down, what a hot key does."""

import re

import pytest
from pyspark.sql import functions as F

from statline.catalog.queries import QUERIES
from statline.operators import drop_orphans, keep_last, keep_matching, orphan_keys, top_n_per_group, totals, upsert
from statline.plans.marts import search_players, team_summary, team_top
from statline.plans.reports import profile
from statline.plans.rulebook import rules_for
from statline.session import stored_in

FOLDER = "/root/testdata/sf0.001"
WRITERS = {"stored_player_view", "top3_csv_report", "landed_csv_players", "landed_json_events", "streamed_csv_players",
           "clean_match_events_stored"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines(df):
    """Operators of the plan from the result down."""
    return [re.sub(r"^[\s:+\-*()\d]*", "", line) for line in plan(df).split("\n")]


def operators(df):
    return [re.match(r"\w*", line).group(0) for line in lines(df)]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def hot(spark):
    """Rows of which a third share one key."""
    ids = spark.range(60_000)
    return ids.select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq"),
                      F.sha2(F.col("id").cast("string"), 256).alias("text"))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stored") / "view")
    QUERIES["player_view"](spark, FOLDER).write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_cross_join_and_no_python(spark, name):
    found = plan(QUERIES[name](spark, FOLDER))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInArrow|MapInPandas|SinglePartition.*Window", found)


def test_groups_are_cut_before_the_shuffle(hot):
    for df in (keep_last(hot, ["k"], ["seq"]), top_n_per_group(hot, ["k"], [F.desc("seq")], 3)):
        steps = operators(df)
        first, last = steps.index("WindowGroupLimit"), len(steps) - 1 - steps[::-1].index("WindowGroupLimit")
        assert first < steps.index("Exchange") < last


def test_a_hot_key_sends_few_rows(spark, hot):
    """Three tasks hold the hot key; each sends one of its rows, so the final stage sees no group above three."""
    spread = hot.repartition(3, "seq")
    assert keep_last(spread, ["k"], ["seq"]).filter("k = 0").first().seq == 59_997
    assert keep_last(hot, ["k"], ["seq"]).count() == hot.select("k").distinct().count()


def test_sums_are_partial_before_the_shuffle(hot):
    steps = lines(totals(hot, ["k"], ["seq"]))
    exchange = next(i for i, s in enumerate(steps) if s.startswith("Exchange"))
    assert any("partial_sum" in s for s in steps[exchange:])


def test_orphans_are_counted_before_the_join(spark, hot, no_broadcast):
    parent = spark.range(100).withColumnRenamed("id", "key")
    steps = operators(orphan_keys(hot, "k", parent, "key"))
    assert "HashAggregate" in steps[steps.index("SortMergeJoin"):]


def test_a_skewed_child_partition_is_split(spark, hot, tmp_path, no_broadcast):
    hot.write.parquet(str(tmp_path / "hot"))
    parent = spark.range(60_000).filter("id % 2 = 0")
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        kept = keep_matching(spark.read.parquet(str(tmp_path / "hot")).repartition(8), {"k": (parent, "id")}, unique=True)
        assert kept.count() == hot.filter("k % 2 = 0").count()
        kept.collect()
        assert "skew=true" in plan(kept)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_a_small_delivery_does_not_shuffle_the_table(spark, hot, tmp_path):
    hot.write.parquet(str(tmp_path / "t"))
    existing = spark.read.parquet(str(tmp_path / "t"))
    merged = upsert(existing, existing.limit(0).union(existing.filter("seq < 10")), ["seq"])
    assert not any("hashpartitioning" in s for s in lines(merged))


def test_search_is_pushed_to_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        for form in ("dataframe", "sql"):
            found = plan(search_players(stored, "Forward", form, goals_min=5, age_max=30))
            pushed = re.search(r"PushedFilters: \[(.*?)\]", found).group(1)
            for condition in ("GreaterThanOrEqual(goals,5)", "LessThanOrEqual(age,30)", "EqualTo(position,Forward)",
                              "GreaterThanOrEqual(g_xg_90,0.0)"):
                assert condition in pushed
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_missing_keys_are_broadcast_instead_of_parents(spark, hot, tmp_path):
    hot.write.parquet(str(tmp_path / "hot"))
    rows = spark.read.parquet(str(tmp_path / "hot"))
    parent = spark.range(59_990)
    parents = {"k": (parent, "id")}
    kept = drop_orphans(rows, parents, rows, stored_in(spark, str(tmp_path / "keys")))
    assert sorted(kept.collect()) == sorted(keep_matching(rows, parents, unique=True).collect())
    steps = lines(kept)
    assert any(s.startswith("BroadcastHashJoin") for s in steps)
    assert not any("hashpartitioning" in s for s in steps)


def test_profiles_read_few_columns(stored):
    opened = search_players(stored.select("player_id", *[c for c in stored.columns if c != "player_id"]))
    narrow = profile(stored, "effective_scorers")
    schema = re.search(r"ReadSchema: struct<(.*)", plan(narrow)).group(1)
    assert "nationality" not in schema and "contract_until" not in schema
    assert set(opened.columns) == set(stored.columns)


def test_team_filter_reaches_the_scan(spark, stored):
    teams = spark.createDataFrame([("T1", "l", "n")], "team_id string, league string, name string")
    for df in (team_summary(stored, teams, "T1"), team_top(stored, teams, "T1"),
               team_summary(stored, teams, "T1", "sql"), team_top(stored, teams, "T1", form="sql")):
        scan = next(s for s in lines(df) if s.startswith("FileScan"))
        assert "EqualTo(team_id,T1)" in scan


def test_teams_are_joined_after_grouping(spark, stored, no_broadcast):
    teams = spark.createDataFrame([("T1", "l", "n")], "team_id string, league string, name string")
    for form in ("dataframe", "sql"):
        steps = operators(team_summary(stored, teams, form=form))
        assert steps.index("SortMergeJoin") < steps.index("HashAggregate")


def test_rules_need_no_shuffle(clean_raw):
    events = clean_raw["match_events"]
    rules = rules_for("match_events", events)
    for df in (rules.violations(events, ["event_id"]), rules.first_violation(events, ["event_id"])):
        assert "Exchange" not in plan(df)
