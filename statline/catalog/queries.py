"""The queries on the test tables: ``{name: (spark, folder) -> DataFrame}``.

The first group runs the scouting plans over the datasets of :mod:`statline.catalog.star`, the second runs the same
operators on the tables as they are. Dates are shown as text, so that results compare alike everywhere.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statline.catalog.star import raw_datasets, table
from statline.functions import (
    age_at, composite_key, json_rows, normalize_date, normalize_label,
)
from statline.operators.date_layouts import read_dates
from statline.operators.exact import exact_totals
from statline.operators import (
    Rate, Ratio, add_derived, duplicate_keys, keep_last, keep_matching, label_census, lookup, null_profile, orphan_keys,
    orphan_rows, range_filter, split_contract, top_n_per_group, totals, upsert, validity,
)
from statline.plans.clean import clean_all, clean_players, clean_teams
from statline.plans.intake import Intake
from statline.plans.marts import player_view, search_players, team_summary, team_top
from statline.plans.metrics import SEARCHABLE
from statline.plans.quality import check_all, check_dataset, quality_report, quality_summary, quality_warnings
from statline.plans.quality_state import QualityLog, state_report, state_summary, state_warnings
from statline.plans.reports import PROFILES, VIEW_TABLE, profile, store_player_view
from statline.plans.rulebook import rules_for
from statline.plans.season import SeasonTotals
from statline.schemas import DATASETS, SEQ
from statline.session import stored_in, work_dir
from statline.sources import KeyedTable, Warehouse, ingest_raw, load_from_landing, write_report
from statline.sources.keyed import bucket_of
from statline.streaming import stream_to_landing, stream_to_tables

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2024, 1, 1)
ONE_TEAM = "T3"


def _text_dates(df: DataFrame) -> DataFrame:
    dates = {f.name: F.col(f.name).cast("string") for f in df.schema.fields
             if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))}
    return df.withColumns(dates) if dates else df


def _cleaned(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return clean_all(raw_datasets(spark, folder, *names), AS_OF, keys=stored_in(spark, work_dir(spark, "keys")))


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Cleaned teams, players and statistics under their table contracts."""
    cleaned = _cleaned(spark, folder, "teams", "players", "matches", "player_match_stats")
    return {name: split_contract(df, DATASETS[name].mart_schema)[0] for name, df in cleaned.items()}


def _fresh_view(spark: SparkSession, folder: str, form: str = "dataframe") -> DataFrame:
    """The player view in one plan, from the raw rows on."""
    tables = _tables(spark, folder)
    return player_view(tables["players"], tables["teams"], tables["player_match_stats"], form)


def _store(spark: SparkSession, folder: str, form: str = "sql") -> Warehouse:
    """Clean, save under contract and store the player view."""
    warehouse = Warehouse(spark, work_dir(spark, "warehouse"))
    raw = raw_datasets(spark, folder, "teams", "players", "matches", "player_match_stats")
    cleaned = clean_all(raw, AS_OF, store=stored_in(spark, work_dir(spark, "cleaned")))
    for name in ("teams", "players", "player_match_stats"):
        warehouse.save(name, cleaned[name])
    store_player_view(warehouse, form)
    return warehouse


_STORED: dict[tuple[str, str], Warehouse] = {}


def _view(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored player view and teams. Searches and reports read them as users do: built once per application."""
    place = (spark.sparkContext.applicationId, folder)
    if place not in _STORED:
        _STORED[place] = _store(spark, folder)
    return _STORED[place].read(VIEW_TABLE), _STORED[place].read(DATASETS["teams"].table)


# --- scouting plans ------------------------------------------------------------------------------------------------------

def _clean(name: str, *needed: str) -> Query:
    return lambda spark, folder: _text_dates(_cleaned(spark, folder, *needed, name)[name].drop(SEQ))


def _shown_view(form: str) -> Query:
    return lambda spark, folder: _text_dates(_fresh_view(spark, folder, form))


def _search(form: str, position: str | None = None, **limits) -> Query:
    return lambda spark, folder: _text_dates(search_players(_view(spark, folder)[0], position, form, **limits))


def _profile(name: str) -> Query:
    return lambda spark, folder: profile(_view(spark, folder)[0], name)


def _summary(form: str, team_id: str | None = None) -> Query:
    return lambda spark, folder: team_summary(*_view(spark, folder), team_id, form)


def _top(form: str, team_id: str | None = None) -> Query:
    return lambda spark, folder: team_top(*_view(spark, folder), team_id, form=form)


def _violations(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        df = raw_datasets(spark, folder, name)[name]
        return rules_for(name, df).violations(df, DATASETS[name].key).drop("place")
    return query


def _orphans(child: str, column: str) -> Query:
    parent = DATASETS[child].references[column]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        raw = raw_datasets(spark, folder, child, parent)
        return orphan_keys(raw[child], column, raw[parent], DATASETS[parent].key[0])
    return query


_BOUNDED = {
    "minutes_played_min": 500, "minutes_played_max": 2500, "goals_max": 12, "pass_accuracy_min": 0.8,
    "g_xg_min": None, "g_xg_90_min": None,
}


def stored_player_view(spark: SparkSession, folder: str) -> DataFrame:
    """Clean, save under contract, build the view from the stored tables and read the stored view."""
    return _text_dates(_store(spark, folder).read(VIEW_TABLE))


def upsert_players(spark: SparkSession, folder: str) -> DataFrame:
    """The first delivery of players, then the second one on top, both under contract."""
    raw = raw_datasets(spark, folder, "teams", "players")
    teams = clean_teams(raw["teams"])

    def delivery(seq: int) -> DataFrame:
        cleaned = clean_players(raw["players"].filter(F.col(SEQ) == seq), teams, AS_OF)
        return split_contract(cleaned, DATASETS["players"].mart_schema)[0]

    return _text_dates(upsert(delivery(1), delivery(2), DATASETS["players"].key))


def stored_clean_events(spark: SparkSession, folder: str) -> DataFrame:
    """Match events cleaned step by step, every table and every set of missing keys stored."""
    cleaned = clean_all(raw_datasets(spark, folder, "teams", "players", "matches", "match_events"), AS_OF,
                        store=stored_in(spark, work_dir(spark, "cleaned")))
    return cleaned["match_events"].drop(SEQ)


def contract_players_quarantined(spark: SparkSession, folder: str) -> DataFrame:
    players = _cleaned(spark, folder, "teams", "players")["players"]
    return _text_dates(split_contract(players, DATASETS["players"].mart_schema)[1].drop(SEQ))


def contract_stats_kept(spark: SparkSession, folder: str) -> DataFrame:
    return _tables(spark, folder)["player_match_stats"]


def null_profile_players(spark: SparkSession, folder: str) -> DataFrame:
    return check_dataset("players", raw_datasets(spark, folder, "players")).nulls


def label_census_positions(spark: SparkSession, folder: str) -> DataFrame:
    return check_dataset("players", raw_datasets(spark, folder, "players")).labels["position"]


def duplicate_stats(spark: SparkSession, folder: str) -> DataFrame:
    return check_dataset("player_match_stats", raw_datasets(spark, folder, "player_match_stats")).duplicates


def top3_csv_report(spark: SparkSession, folder: str) -> DataFrame:
    """The top list written as a CSV report and read back."""
    listed = team_top(*_view(spark, folder))
    path = write_report(listed, work_dir(spark, "reports"), "team_top3_all")
    return spark.read.schema(listed.schema).option("header", True).csv(path)


def landed_csv_players(spark: SparkSession, folder: str) -> DataFrame:
    """Raw players written as a CSV folder, ingested and loaded from landing."""
    root = work_dir(spark, "ingest")
    raw_datasets(spark, folder, "players")["players"].drop(SEQ).write.option("header", True).csv(f"{root}/raw/players.csv")
    ingest_raw(spark, f"{root}/raw", f"{root}/landing", Warehouse(spark, f"{root}/state"))
    return load_from_landing(spark, f"{root}/landing")["players"].drop(SEQ)


def landed_json_events(spark: SparkSession, folder: str) -> DataFrame:
    """Match events landed as JSON documents, one list of records per cell, and expanded to rows."""
    spec = DATASETS["match_events"]
    raw = raw_datasets(spark, folder, "match_events")["match_events"]
    record = F.struct(*spec.raw)
    cells = raw.select(F.concat("event_id", F.lit(".json")).alias("file"), F.to_json(F.array(record)).alias("data"))
    landing = work_dir(spark, "landing")
    cells.write.parquet(f"{landing}/match_events.parquet")
    rows = load_from_landing(spark, landing)["match_events"]
    return rows.select(*[F.col(n).try_cast(t).alias(n) for n, t in spec.raw.items()])


def _write_json_documents(rows: DataFrame, path: str, documents: int) -> None:
    """Rows as ``documents`` files, each one list of all its records between two elements that are no records."""
    of = F.pmod(F.crc32(F.col(rows.columns[0])), F.lit(documents)).cast("int").alias("document")
    spark = rows.sparkSession
    ends = spark.range(documents).select(F.col("id").cast("int").alias("document"), F.explode(F.array(
        *[F.struct(F.lit(i).alias("place"), F.lit(t).alias("value")) for i, t in ((0, "[5"), (2, ', "odd"]'))])).alias("e"))
    lines = rows.select(of, F.lit(1).alias("place"), F.concat(F.lit(","), F.to_json(F.struct(*rows.columns))).alias("value"))
    (ends.select("document", "e.*").unionByName(lines).repartition("document").sortWithinPartitions("document", "place")
     .drop("place").write.partitionBy("document").text(path))


def landed_json_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Matches written as JSON files of very many records, ingested block by block and loaded from landing."""
    root, spec = work_dir(spark, "documents"), DATASETS["matches"]
    raw = raw_datasets(spark, folder, "matches")["matches"]
    _write_json_documents(raw.select(*spec.raw), f"{root}/raw/matches.json", documents=32)
    ingest_raw(spark, f"{root}/raw", f"{root}/landing", Warehouse(spark, f"{root}/state"))
    rows = load_from_landing(spark, f"{root}/landing")["matches"]
    return rows.select(*[F.col(n).try_cast(t).alias(n) for n, t in spec.raw.items()])


def second_delivery_players(spark: SparkSession, folder: str) -> DataFrame:
    """Players in two deliveries, taken by manifest: what the second run lands."""
    root = work_dir(spark, "deliveries")
    house, raw = Warehouse(spark, f"{root}/state"), raw_datasets(spark, folder, "players")["players"]
    for seq in (1, 2):
        part = raw.filter(F.col(SEQ) == seq).drop(SEQ)
        part.coalesce(4).write.option("header", True).csv(f"{root}/raw/players.csv/delivery={seq}")
        ingest_raw(spark, f"{root}/raw", f"{root}/landing", house, by="manifest")
    return load_from_landing(spark, f"{root}/landing")["players"].drop(SEQ)


def streamed_csv_players(spark: SparkSession, folder: str) -> DataFrame:
    """Raw players written as CSV files and landed by the stream."""
    root = work_dir(spark, "stream")
    raw_datasets(spark, folder, "players")["players"].drop(SEQ).write.option("header", True).csv(f"{root}/raw")
    query = stream_to_landing(spark, "players", f"{root}/raw", f"{root}/landing", f"{root}/checkpoint", pattern="*.csv")
    query.awaitTermination()
    return load_from_landing(spark, f"{root}/landing")["players"].drop(SEQ)


def streamed_players_table(spark: SparkSession, folder: str) -> DataFrame:
    """Players streamed into their table in two deliveries, the first before its teams have come."""
    root, raw = work_dir(spark, "stream"), raw_datasets(spark, folder, "teams", "players")
    intake = Intake(Warehouse(spark, f"{root}/warehouse"), AS_OF)

    def stream(dataset: str, rows: DataFrame, part: str) -> None:
        rows.drop(SEQ).coalesce(4).write.option("header", True).csv(f"{root}/raw/{dataset}/{part}")
        stream_to_tables(spark, dataset, f"{root}/raw/{dataset}", intake, f"{root}/odd", f"{root}/checkpoint",
                         pattern="*.csv").awaitTermination()

    stream("players", raw["players"].filter(F.col(SEQ) == 1), "first")
    # One copy a team: files do not keep the order of rows that were in a table.
    stream("teams", clean_teams(raw["teams"]), "all")
    stream("players", raw["players"].filter(F.col(SEQ) == 2), "second")
    return _text_dates(intake.warehouse.read(DATASETS["players"].table))


def late_parents_events(spark: SparkSession, folder: str) -> DataFrame:
    """Match events that were delivered before their players, matches and teams: those kept, and those that still wait."""
    raw = raw_datasets(spark, folder, "match_events", "players", "matches", "teams")
    intake = Intake(Warehouse(spark, work_dir(spark, "intake")), AS_OF)
    for name in ("match_events", "players", "matches", "teams"):
        intake.deliver({name: raw[name]}, 1)
    kept, waiting = intake.warehouse.read(DATASETS["match_events"].table), intake.waiting("match_events")
    shown = ["event_id", "match_id", "team_id", "player_id", "event_type", F.col("minute").cast("bigint").alias("minute")]
    return (kept.select(*shown, F.lit("kept").alias("state"))
            .unionByName(waiting.select(*shown, F.lit("waiting").alias("state"))))


# --- operators on the tables as they are -----------------------------------------------------------------------------------

SUPPLIER_DERIVED = {
    "revenue_90": Rate("revenue", "quantity", 90),
    "returned_90": Rate("returned", "quantity", 90),
    "return_rate": Ratio("returned", ("quantity",)),
    "open_share": Ratio("open_lines", ("open_lines", "shipped_lines")),
}


def supplier_season(spark: SparkSession, folder: str) -> DataFrame:
    """Totals, rates and ratios of order lines per supplier; a supplier without lines stays, with nulls."""
    lines = table(spark, folder, "lineitem")
    quantity = F.col("l_quantity").cast("bigint")
    measured = lines.select(
        "l_suppkey", quantity.alias("quantity"), F.col("l_extendedprice").cast("decimal(12,2)").alias("revenue"),
        F.when(F.col("l_returnflag") == "R", quantity).otherwise(0).alias("returned"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("open_lines"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("shipped_lines"),
    )
    summed = totals(measured, ["l_suppkey"], ["quantity", "revenue", "returned", "open_lines", "shipped_lines"])
    season = add_derived(summed.withColumn("revenue", F.col("revenue").cast("double")), SUPPLIER_DERIVED)
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    named = lookup(suppliers, nations, "n_nationkey").drop("n_nationkey").withColumnRenamed("s_suppkey", "supplier")
    return lookup(named, season.withColumnRenamed("l_suppkey", "supplier"), "supplier")


def keep_last_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    order = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
             "l_linestatus", "l_shipdate")
    return _text_dates(keep_last(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], order))


def duplicate_lineitem_keys(spark: SparkSession, folder: str) -> DataFrame:
    repeated = duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
    key = composite_key(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return repeated.select(key.alias("line_key"), "n_rows")


def semi_lineitem_open_orders(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "O")
    parts = table(spark, folder, "part").filter(F.col("p_size") <= 25)
    parents = {"l_partkey": (parts, "p_partkey"), "l_orderkey": (orders, "o_orderkey")}
    return keep_matching(lines, parents, unique=True).select(*lines.columns)


def orphan_lineitem_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    finished = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F")
    return orphan_rows(lines, "l_orderkey", finished, "o_orderkey")


def orphan_event_users(spark: SparkSession, folder: str) -> DataFrame:
    solvent = table(spark, folder, "customer").filter(F.col("c_acctbal") > 0)
    return orphan_keys(table(spark, folder, "events"), "user_id", solvent, "c_custkey")


def null_profile_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        F.when(F.col("value") <= 100, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("props"),
    )
    return null_profile(events, ["value", "props"])


def label_census_part_type(spark: SparkSession, folder: str) -> DataFrame:
    return label_census(table(spark, folder, "part"), "p_type")


def validity_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return validity(table(spark, folder, "lineitem"), F.col("l_discount") > F.col("l_tax"))


def null_out_prices(spark: SparkSession, folder: str) -> DataFrame:
    discount = F.col("l_discount")
    kept = F.when((discount < 0.02) | (discount > F.col("l_tax")), None).otherwise(discount)
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", kept.alias("l_discount"))


def normalize_segments(spark: SparkSession, folder: str) -> DataFrame:
    groups = {"Home": ("furniture", "household"), "Engines": ("machinery", "automobile")}
    segment = normalize_label(F.col("c_mktsegment"), groups, "Other")
    return table(spark, folder, "customer").select("c_custkey", segment.alias("segment"))


def normalize_order_dates(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate")
    written = (F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd"))
               .when(F.col("o_orderstatus") == "O", F.date_format(day, " dd/MM/yyyy "))
               .otherwise(F.date_format(day, "yyyy/MM/dd")))
    return _text_dates(table(spark, folder, "orders").select(
        "o_orderkey", normalize_date(written).alias("month_first"), normalize_date(written, True).alias("day_first")))


def exact_price_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Sums and means of prices with all their digits, which no order of the lines changes."""
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_extendedprice", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    return exact_totals(lines, ["l_returnflag", "l_linestatus"], ["l_extendedprice", "net"])


def dates_by_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates written in many layouts, each column read the way its own days over 12 show."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey") % 6

    def written(last: str) -> Column:
        return (F.when(key == 0, F.date_format(day, "yyyyMMdd")).when(key == 1, F.date_format(day, "d MMM yyyy"))
                .when(key == 2, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(key == 3, F.date_format(day, "MMMM d, yyyy"))
                .otherwise(F.date_format(day, last)))

    orders = table(spark, folder, "orders").select(
        "o_orderkey", written("dd/MM/yyyy").alias("day_first"), written("MM.dd.yyyy").alias("month_first"))
    return _text_dates(read_dates(orders, ["day_first", "month_first"]))


def order_age(spark: SparkSession, folder: str) -> DataFrame:
    age = age_at(F.col("o_orderdate").cast("date"), F.lit(AS_OF))
    return table(spark, folder, "orders").select("o_orderkey", age.alias("age"))


def top3_orders_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    order = [F.desc_nulls_last("o_totalprice"), F.asc("o_orderkey")]
    return top_n_per_group(orders, ["o_custkey"], order, 3, rank="ranking")


def range_search_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    bounds = {"l_quantity": (10, 30), "l_discount": (0.05, None), "l_extendedprice": (None, 50000)}
    found = range_filter(table(spark, folder, "lineitem"), bounds, {"l_returnflag": "R"})
    return found.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice")


def json_props(spark: SparkSession, folder: str) -> DataFrame:
    record = T.StructType([T.StructField("k", T.LongType())])
    return json_rows(table(spark, folder, "events").select("event_id", "props"), "props", record)


def json_array_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Two measures of every order line written as a JSON list and read back as rows."""
    def record(measure: str, column: str):
        return F.struct(F.lit(measure).alias("measure"), F.col(column).alias("amount"))

    cell = F.to_json(F.array(record("quantity", "l_quantity"), record("price", "l_extendedprice")))
    cells = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", cell.alias("cell"))
    fields = T.StructType([T.StructField("measure", T.StringType()), T.StructField("amount", T.DoubleType())])
    return json_rows(cells, "cell", fields)


def union_accounts(spark: SparkSession, folder: str) -> DataFrame:
    def accounts(kind: str, name: str, prefix: str, key: str) -> DataFrame:
        return table(spark, folder, name).select(
            F.lit(kind).alias("kind"), F.col(key).alias("account"), F.col(f"{prefix}_nationkey").alias("nation"),
            F.col(f"{prefix}_acctbal").alias("balance"))

    customers = accounts("customer", "customer", "c", "c_custkey")
    return customers.unionByName(accounts("supplier", "supplier", "s", "s_suppkey"))


def upsert_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    existing = orders.filter(F.col("o_orderstatus").isin("F", "O"))
    incoming = orders.filter(F.col("o_orderstatus").isin("O", "P")).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return upsert(existing, incoming, ["o_orderkey"])


def _deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """The quality state of all raw rows, come in two deliveries of which each was read once: first copies and later ones,
    order lines of even and of odd minutes."""
    log, raw = QualityLog(Warehouse(spark, work_dir(spark, "quality"))), raw_datasets(spark, folder)
    second = {n: (F.col("minutes_played") % 2 == 1) if n == "player_match_stats" else F.col(SEQ) == 2 for n in raw}
    for delivery in (1, 2):
        log.add(str(delivery), {n: df.filter(second[n] if delivery == 2 else ~second[n]) for n, df in raw.items()})
    return stored_in(spark, work_dir(spark, "quality"))("total", log.total())


def season_after_corrections(spark: SparkSession, folder: str) -> DataFrame:
    """Season metrics after a first delivery with wrong and missing rows and a second that corrects them, by signed changes."""
    stats = stored_in(spark, work_dir(spark, "season"))("stats", _tables(spark, folder)["player_match_stats"])
    wrong, missing = F.col("minutes_played") % 2 == 0, F.col("red_cards") > 0
    first = stats.filter(~missing).withColumns({
        "goals": F.when(wrong, F.col("goals") + 3).otherwise(F.col("goals")).cast("int"),
        "xg": F.when(wrong, None).otherwise(F.col("xg")), "xa": F.when(wrong, F.lit(0.7)).otherwise(F.col("xa")).cast("float")})
    season = SeasonTotals(spark, work_dir(spark, "season"), buckets=16)
    season.apply(first)
    season.apply(stats.filter(wrong | missing))
    return season.season()


KEYED_BUCKETS = 64


def upsert_orders_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in 64 partitions by key, and a delivery of one customer's repriced orders: the rows and prices of each partition
    afterwards, and how many of its rows the delivery had to write."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    root = work_dir(spark, "keyed")
    keyed = KeyedTable(spark, f"{root}/orders", ["o_orderkey"], KEYED_BUCKETS)
    keyed.merge(orders)
    first = orders.filter(F.col("o_custkey") == orders.agg(F.min("o_custkey")).first()[0])
    repriced = stored_in(spark, root)("delivery", first.withColumn("o_totalprice", F.col("o_totalprice") * 2))
    hit = keyed.merge(repriced).buckets
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    bucket = bucket_of(["o_orderkey"], KEYED_BUCKETS)
    kept = keyed.read().groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(cents).alias("cents"))
    return kept.withColumn("n_written", F.when(F.col("bucket").isin(hit), F.col("n_rows")).otherwise(F.lit(0).cast("bigint")))


QUERIES: dict[str, Query] = {
    "clean_teams": _clean("teams"),
    "clean_players": _clean("players", "teams"),
    "clean_matches": _clean("matches"),
    "clean_player_match_stats": _clean("player_match_stats", "teams", "players", "matches"),
    "clean_match_events": _clean("match_events", "teams", "players", "matches"),
    "clean_match_events_stored": stored_clean_events,
    "player_view": _shown_view("dataframe"),
    "player_view_sql": _shown_view("sql"),
    "stored_player_view": stored_player_view,
    "range_search_default": _search("dataframe"),
    "range_search_default_sql": _search("sql"),
    "range_search_bounded": _search("dataframe", "Forward", **_BOUNDED),
    "range_search_bounded_sql": _search("sql", "Forward", **_BOUNDED),
    "range_search_open": _search("dataframe", **{f"{c}_min": None for c in SEARCHABLE}, age_max=30),
    **{f"profile_{name}": _profile(name) for name in PROFILES},
    "team_summary": _summary("dataframe"),
    "team_summary_sql": _summary("sql"),
    "team_summary_one": _summary("dataframe", ONE_TEAM),
    "team_summary_one_sql": _summary("sql", ONE_TEAM),
    "top3_per_team": _top("dataframe"),
    "top3_per_team_sql": _top("sql"),
    "top3_one_team": _top("dataframe", ONE_TEAM),
    "top3_one_team_sql": _top("sql", ONE_TEAM),
    "top3_csv_report": top3_csv_report,
    **{f"violations_{name}": _violations(name) for name in DATASETS},
    **{f"orphans_{child}_{parent}": _orphans(child, column)
       for child, spec in DATASETS.items() for column, parent in spec.references.items()},
    "duplicate_stats": duplicate_stats,
    "null_profile_players": null_profile_players,
    "label_census_positions": label_census_positions,
    "quality_summary": lambda spark, folder: quality_summary(check_all(raw_datasets(spark, folder))),
    "quality_warnings": lambda spark, folder: quality_warnings(check_all(raw_datasets(spark, folder))),
    "quality_report": lambda spark, folder: quality_report(check_all(raw_datasets(spark, folder))),
    "quality_summary_deliveries": lambda spark, folder: state_summary(_deliveries(spark, folder)),
    "quality_warnings_deliveries": lambda spark, folder: state_warnings(_deliveries(spark, folder)),
    "quality_report_deliveries": lambda spark, folder: state_report(_deliveries(spark, folder)),
    "contract_players_quarantined": contract_players_quarantined,
    "contract_stats_kept": contract_stats_kept,
    "upsert_players": upsert_players,
    "season_after_corrections": season_after_corrections,
    "landed_csv_players": landed_csv_players,
    "landed_json_events": landed_json_events,
    "landed_json_matches": landed_json_matches,
    "second_delivery_players": second_delivery_players,
    "streamed_csv_players": streamed_csv_players,
    "streamed_players_table": streamed_players_table,
    "late_parents_events": late_parents_events,
    "supplier_season": supplier_season,
    "keep_last_lineitem": keep_last_lineitem,
    "duplicate_lineitem_keys": duplicate_lineitem_keys,
    "semi_lineitem_open_orders": semi_lineitem_open_orders,
    "orphan_lineitem_rows": orphan_lineitem_rows,
    "orphan_event_users": orphan_event_users,
    "null_profile_events": null_profile_events,
    "label_census_part_type": label_census_part_type,
    "validity_lineitem": validity_lineitem,
    "null_out_prices": null_out_prices,
    "normalize_segments": normalize_segments,
    "normalize_order_dates": normalize_order_dates,
    "exact_price_totals": exact_price_totals,
    "dates_by_evidence": dates_by_evidence,
    "order_age": order_age,
    "top3_orders_per_customer": top3_orders_per_customer,
    "range_search_lineitem": range_search_lineitem,
    "json_props": json_props,
    "json_array_rows": json_array_rows,
    "union_accounts": union_accounts,
    "upsert_orders": upsert_orders,
    "upsert_orders_partitions": upsert_orders_partitions,
}
