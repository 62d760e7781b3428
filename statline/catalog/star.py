"""Raw scouting datasets derived from the test tables.

Nations act as teams, parts and customers as players, orders as matches, order lines as match statistics and events as
match events, with the faults raw deliveries have: copies, orphans, mixed layouts, missing and impossible values. The
selects are plain SQL that Spark and DuckDB read alike, so both sides of a comparison start from the same rows. Every
select reads its tables whole; ``_seq`` orders the copies of a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _iso(day: str) -> str:
    return f"CAST({day} AS STRING)"


def _slashed(day: str) -> str:
    two = "LPAD(CAST({part}({day}) AS STRING), 2, '0')"
    parts = [two.format(part=p, day=day) for p in ("DAY", "MONTH")]
    return f"{parts[0]} || '/' || {parts[1]} || '/' || CAST(YEAR({day}) AS STRING)"


def _year_slashed(day: str) -> str:
    return f"REPLACE(CAST({day} AS STRING), '-', '/')"


# Teams: every nation, and the nations of America once more under a longer name.
_TEAM = """
    SELECT 'T' || CAST(n_nationkey AS STRING) AS team_id, {name} AS name, r_name AS league,
           CASE WHEN n_nationkey = 7 THEN NULL ELSE 'Stadium ' || n_name END AS stadium,
           'City ' || CAST(n_nationkey AS STRING) AS city, CAST({seq} AS BIGINT) AS _seq
    FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey {where}
"""
TEAMS = (
    _TEAM.format(name="n_name", seq=1, where="")
    + " UNION ALL "
    + _TEAM.format(name="n_name || ' United'", seq=2, where="WHERE r_name = 'AMERICA'")
)

# Players: parts (team from the size, half of which have no nation) and customers, and promoted parts once more in
# another team.
_BORN = "(DATE '1980-01-01' + CAST(p_partkey % 7300 AS INT))"
_CUSTOMER_BORN = "(DATE '1999-06-30' + CAST(c_custkey % 2500 AS INT))"
_PART_PLAYER = """
    SELECT 'P' || CAST(p_partkey AS STRING) AS player_id, p_name AS name, {team} AS team_id,
           CASE p_type WHEN 'ECONOMY' THEN 'GK' WHEN 'SMALL' THEN 'Centre-Back' WHEN 'STANDARD' THEN 'CM'
                WHEN 'LARGE' THEN 'Striker' WHEN 'MEDIUM' THEN 'Central Midfielder' ELSE {promo} END AS position,
           CASE WHEN p_size < 20 THEN {iso} WHEN p_size < 40 THEN {slashed} WHEN p_size < 45 THEN {year_slashed}
                WHEN p_size < 49 THEN {iso} ELSE 'unknown' END AS date_of_birth,
           p_brand AS nationality,
           CASE WHEN p_type = 'SMALL' THEN NULL WHEN p_size = 13 THEN 'n/a' WHEN p_size = 14 THEN '-1'
                ELSE CAST(CAST(ROUND(p_retailprice * 10000) AS BIGINT) AS STRING) END AS market_value,
           CASE WHEN p_type = 'LARGE' THEN NULL ELSE '30/06/2027' END AS contract_until,
           CAST({seq} AS BIGINT) AS _seq
    FROM {{part}} {where}
"""
_DATES = {"iso": _iso(_BORN), "slashed": _slashed(_BORN), "year_slashed": _year_slashed(_BORN)}
PLAYERS = (
    _PART_PLAYER.format(team="'T' || CAST(p_size - 1 AS STRING)", promo="'Winger'", seq=1, where="", **_DATES)
    + " UNION ALL "
    + _PART_PLAYER.format(team="'T' || CAST(50 - p_size AS STRING)", promo="NULL", seq=2,
                          where="WHERE p_type = 'PROMO'", **_DATES)
    + f"""
    UNION ALL
    SELECT 'C' || CAST(c_custkey AS STRING) AS player_id, c_name AS name,
           'T' || CAST(c_nationkey AS STRING) AS team_id, LOWER(c_mktsegment) AS position,
           {_iso(_CUSTOMER_BORN)} AS date_of_birth, 'Nation ' || CAST(c_nationkey AS STRING) AS nationality,
           CAST(CAST(ROUND(c_acctbal) AS BIGINT) AS STRING) AS market_value, '2026-06-30' AS contract_until,
           CAST(1 AS BIGINT) AS _seq
    FROM {{customer}}
    """
)

# Matches: every order, urgent ones once more with another score.
_DAY = "CAST(o_orderdate AS DATE)"
_MATCH = """
    SELECT 'M' || CAST(o_orderkey AS STRING) AS match_id, o_orderpriority AS competition,
           CAST(YEAR(o_orderdate) AS STRING) AS season,
           CASE o_orderstatus WHEN 'F' THEN {iso} WHEN 'O' THEN {slashed} ELSE {year_slashed} END AS match_date,
           'T' || CAST(o_custkey % 25 AS STRING) AS home_team_id,
           'T' || CAST(o_orderkey % 25 AS STRING) AS away_team_id,
           CAST(CAST(o_custkey % 6 AS BIGINT) + {shift} AS BIGINT) AS home_score,
           CAST(o_orderkey % 5 AS BIGINT) AS away_score,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL
                ELSE 'Venue ' || CAST(o_custkey % 25 AS STRING) END AS venue,
           CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'closed'
                ELSE CAST(CAST(ROUND(o_totalprice) AS BIGINT) AS STRING) END AS attendance,
           'Referee ' || CAST(o_custkey AS STRING) AS referee, CAST({seq} AS BIGINT) AS _seq
    FROM {{orders}} {where}
"""
_MATCH_DATES = {"iso": _iso(_DAY), "slashed": _slashed(_DAY), "year_slashed": _year_slashed(_DAY)}
MATCHES = (
    _MATCH.format(shift=0, seq=1, where="", **_MATCH_DATES)
    + " UNION ALL "
    + _MATCH.format(shift=-1, seq=2, where="WHERE o_orderpriority = '1-URGENT'", **_MATCH_DATES)
)

# Match statistics: every order line. The position text holds all values the line is made from, so copies with the same
# text are the same in every column.
PLAYER_MATCH_STATS = """
    SELECT CASE WHEN tax = 8 THEN 'X' || CAST(l_suppkey AS STRING) ELSE 'P' || CAST(l_partkey AS STRING) END AS player_id,
           CASE WHEN disc = 10 AND line = 7 THEN 'N' || CAST(l_orderkey AS STRING)
                ELSE 'M' || CAST(l_orderkey AS STRING) END AS match_id,
           CASE WHEN l_returnflag = 'N' AND line > 5 THEN CAST(0 AS BIGINT) ELSE 40 + qty END AS minutes_played,
           CASE WHEN tax > 5 THEN tax - 5 ELSE CAST(0 AS BIGINT) END AS goals,
           CASE WHEN disc > 8 THEN disc - 8 ELSE CAST(0 AS BIGINT) END AS assists,
           CASE WHEN disc = 0 THEN CAST(0 AS BIGINT) ELSE line END AS shots,
           CAST(FLOOR(tax / 2) AS BIGINT) AS shots_on_target,
           qty * 2 AS passes_attempted,
           CASE WHEN l_linestatus = 'O' THEN qty * 2 - line ELSE qty + line * 3 END AS passes_completed,
           CASE WHEN disc > 5 THEN disc - 5 ELSE CAST(0 AS BIGINT) END AS key_passes,
           tax AS tackles, line - 1 AS interceptions, disc AS duels_won, 10 - disc AS duels_lost,
           tax AS fouls_committed,
           CASE WHEN line = 7 THEN tax ELSE CAST(0 AS BIGINT) END AS yellow_cards,
           CASE WHEN qty = 50 THEN line ELSE CAST(0 AS BIGINT) END AS red_cards,
           CASE WHEN line = 1 THEN CAST(qty AS DOUBLE) / 10 ELSE CAST(disc - 1 AS DOUBLE) / 10 END AS xg,
           CAST(tax AS DOUBLE) / 20 AS xa,
           CAST(line AS STRING) || '-' || LPAD(CAST(qty AS STRING), 4, '0') || '-' || LPAD(CAST(disc AS STRING), 3, '0')
               || '-' || LPAD(CAST(tax AS STRING), 3, '0') || '-' || l_returnflag || l_linestatus AS _seq
    FROM (
        SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) AS line,
               CAST(l_quantity AS BIGINT) AS qty, CAST(FLOOR(l_discount * 100 + 0.5) AS BIGINT) AS disc,
               CAST(FLOOR(l_tax * 100 + 0.5) AS BIGINT) AS tax
        FROM {lineitem}
    ) lines
"""

# Match events: every event, sign-ups once more with other coordinates.
_EVENT = """
    SELECT 'E' || CAST(event_id AS STRING) AS event_id, 'M' || CAST(event_id * 2 AS STRING) AS match_id,
           CASE WHEN event_type = 'error' AND value > 20 THEN CAST(-1 AS BIGINT)
                ELSE CAST(MINUTE(ts) AS BIGINT) END AS minute,
           CASE WHEN value > 30 THEN CAST(60 AS BIGINT) ELSE CAST(SECOND(ts) AS BIGINT) END AS second,
           CASE event_type WHEN 'purchase' THEN 'pass' WHEN 'signup' THEN 'pass' WHEN 'click' THEN 'shot'
                WHEN 'view' THEN 'tackle' ELSE 'dribble' END AS event_type,
           CASE WHEN event_type = 'error' THEN 'X' ELSE 'C' END || CAST(user_id AS STRING) AS player_id,
           'T' || CAST(user_id % 27 AS STRING) AS team_id,
           k * 1.05 + {shift} AS x_start,
           CASE WHEN value > 150 THEN CAST(50 AS DOUBLE) WHEN value < 0.1 THEN NULL ELSE value END AS y_start,
           CASE WHEN event_type = 'purchase' THEN 100 - k WHEN event_type = 'signup' AND k < 90 THEN k
                WHEN event_type = 'click' THEN CAST(95 AS DOUBLE) END AS x_end,
           CASE WHEN event_type = 'purchase' THEN k WHEN event_type = 'signup' AND k > 5 THEN k * 1.02
                WHEN event_type = 'click' THEN CAST(50 AS DOUBLE) END AS y_end,
           CASE WHEN value < 0.5 THEN NULL ELSE 'successful' END AS outcome,
           CASE WHEN event_type = 'purchase' THEN 'right_foot' WHEN event_type = 'signup' AND k > 50 THEN 'head'
                WHEN event_type = 'click' AND value > 5 THEN 'left_foot' END AS body_part,
           CASE WHEN event_type = 'purchase' THEN 'cross' WHEN event_type = 'signup' AND k < 80 THEN 'through_ball'
                END AS pass_type,
           CASE WHEN event_type = 'purchase' OR (event_type = 'signup' AND k < 70) THEN 'C' || CAST(user_id AS STRING)
                END AS recipient_id,
           CAST({seq} AS BIGINT) AS _seq
    FROM (
        SELECT *, CAST(SUBSTRING(props, 7, LENGTH(props) - 7) AS DOUBLE) AS k FROM {{events}}
    ) parsed {where}
"""
MATCH_EVENTS = (
    _EVENT.format(shift="0", seq=1, where="")
    + " UNION ALL "
    + _EVENT.format(shift="0.5", seq=2, where="WHERE event_type = 'signup'")
)

RAW = {
    "teams": TEAMS, "players": PLAYERS, "matches": MATCHES, "player_match_stats": PLAYER_MATCH_STATS,
    "match_events": MATCH_EVENTS,
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_datasets(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """The raw datasets of these names, all by default."""
    datasets = {}
    for name in names or RAW:
        used = {t: table(spark, folder, t) for t in TABLES if "{" + t + "}" in RAW[name]}
        datasets[name] = spark.sql(RAW[name], **used)
    return datasets


def raw_sql(name: str) -> str:
    """The same select over tables of the same names."""
    return RAW[name].format(**{t: t for t in TABLES})
