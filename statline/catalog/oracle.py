"""DuckDB SQL that each query of :mod:`statline.catalog.queries` must agree with.

Written from the rules, not generated from the Spark plans: only the raw derivations and the column lists are shared.
"""

from __future__ import annotations

import re

from statline.catalog.star import raw_sql
from statline.plans.metrics import DERIVED, SEARCHABLE, TOTALS

AS_OF = "DATE '2024-01-01'"

COUNTS = (
    "minutes_played", "goals", "assists", "shots", "shots_on_target", "passes_attempted", "passes_completed",
    "key_passes", "tackles", "interceptions", "duels_won", "duels_lost", "fouls_committed", "yellow_cards", "red_cards",
)


def _date(text: str) -> str:
    layouts = ("%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d/%m/%Y")
    return f"CAST(COALESCE({', '.join(f'''try_strptime(TRIM({text}), '{x}')''' for x in layouts)}) AS DATE)"


def _checked(text: str) -> str:
    return f"COALESCE(try_strptime({text}, '%Y-%m-%d'), try_strptime({text}, '%d/%m/%Y'))"


def _age(born: str, as_of: str = AS_OF) -> str:
    return (f"CAST(YEAR({as_of}) - YEAR({born}) - CASE WHEN MONTH({as_of}) < MONTH({born}) OR (MONTH({as_of}) = "
            f"MONTH({born}) AND DAY({as_of}) < DAY({born})) THEN 1 ELSE 0 END AS INTEGER)")


_POSITION = """
    CASE WHEN LOWER(position) IN ('gk', 'goalkeeper') THEN 'Goalkeeper'
         WHEN LOWER(position) IN ('defender', 'cb', 'centre-back') THEN 'Defender'
         WHEN LOWER(position) IN ('midfielder', 'cm', 'central midfielder') THEN 'Midfielder'
         WHEN LOWER(position) IN ('forward', 'striker', 'st') THEN 'Forward'
         ELSE 'Unknown' END
"""

CTES = {f"raw_{n}": raw_sql(n) for n in ("teams", "players", "matches", "player_match_stats", "match_events")}
CTES |= {
    "c_teams": """
        SELECT * FROM raw_teams QUALIFY ROW_NUMBER() OVER (PARTITION BY team_id ORDER BY _seq DESC) = 1
    """,
    "c_players": f"""
        SELECT *, {_age("date_of_birth")} AS age FROM (
            SELECT player_id, name, team_id, {_POSITION} AS position, {_date("date_of_birth")} AS date_of_birth,
                   nationality, TRY_CAST(market_value AS DOUBLE) AS market_value,
                   {_date("contract_until")} AS contract_until
            FROM raw_players WHERE team_id IN (SELECT team_id FROM c_teams)
            QUALIFY ROW_NUMBER() OVER (PARTITION BY player_id ORDER BY _seq DESC) = 1
        )
    """,
    "c_matches": f"""
        SELECT * REPLACE ({_date("match_date")} AS match_date, TRY_CAST(attendance AS BIGINT) AS attendance)
        FROM raw_matches QUALIFY ROW_NUMBER() OVER (PARTITION BY match_id ORDER BY _seq DESC) = 1
    """,
    "c_stats": """
        SELECT * EXCLUDE (_seq), goals + assists AS goal_contribution, goals - xg AS g_xg FROM (
            SELECT * REPLACE (CASE WHEN xg < 0 OR xg > shots THEN NULL ELSE xg END AS xg)
            FROM raw_player_match_stats
            WHERE player_id IN (SELECT player_id FROM c_players) AND match_id IN (SELECT match_id FROM c_matches)
            QUALIFY ROW_NUMBER() OVER (PARTITION BY player_id, match_id ORDER BY _seq DESC) = 1
        )
    """,
    "c_events": """
        SELECT * FROM raw_match_events
        WHERE match_id IN (SELECT match_id FROM c_matches) AND team_id IN (SELECT team_id FROM c_teams)
          AND player_id IN (SELECT player_id FROM c_players)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY _seq DESC) = 1
    """,
    "late_events": """
        SELECT r.* FROM raw_match_events r LEFT JOIN c_events c ON r.event_id = c.event_id
        WHERE (c.event_id IS NULL OR r._seq > c._seq)
          AND r.match_id IS NOT NULL AND r.team_id IS NOT NULL AND r.player_id IS NOT NULL
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY r.event_id, r.match_id, r.team_id, r.player_id ORDER BY r._seq DESC) = 1
    """,
    "teams": "SELECT * EXCLUDE (_seq) FROM c_teams WHERE stadium IS NOT NULL",
    "players": """
        SELECT * REPLACE (CAST(market_value AS INTEGER) AS market_value) FROM c_players
        WHERE name IS NOT NULL AND date_of_birth IS NOT NULL AND nationality IS NOT NULL AND age IS NOT NULL
    """,
    "stats": f"""
        SELECT player_id, match_id, {", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in COUNTS)},
               CAST(xg AS FLOAT) AS xg, CAST(xa AS FLOAT) AS xa,
               CAST(goal_contribution AS INTEGER) AS goal_contribution, CAST(g_xg AS FLOAT) AS g_xg
        FROM c_stats
    """,
    "season": """
        SELECT player_id,
               {sums},
               {rates},
               ROUND(CASE WHEN SUM(shots) > 0 THEN SUM(shots_on_target) / SUM(shots) END, 2) AS shot_accuracy,
               ROUND(CASE WHEN SUM(passes_attempted) > 0 THEN SUM(passes_completed) / SUM(passes_attempted) END, 2)
                   AS pass_accuracy,
               ROUND(CASE WHEN SUM(duels_won) + SUM(duels_lost) > 0
                          THEN SUM(duels_won) / (SUM(duels_won) + SUM(duels_lost)) END, 2) AS duel_win_rate
        FROM stats GROUP BY player_id
    """.format(
        sums=", ".join(
            f"SUM({c}) AS {c}" if c in ("xg", "xa", "g_xg") else f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in TOTALS
        ),
        rates=", ".join(
            f"ROUND(CASE WHEN SUM(minutes_played) > 0 THEN SUM({source}) / SUM(minutes_played) * 90 END, 2) AS {name}"
            for source, name in (
                ("goals", "goals_90"), ("assists", "assists_90"), ("passes_attempted", "passes_attempted_90"),
                ("passes_completed", "passes_completed_90"), ("key_passes", "key_passes_90"),
                ("tackles", "tackles_90"), ("interceptions", "interceptions_90"), ("fouls_committed", "fouls_90"),
                ("yellow_cards", "yellow_cards_90"), ("red_cards", "red_cards_90"), ("xg", "xg_90"), ("xa", "xa_90"),
                ("goal_contribution", "goal_contribution_90"), ("g_xg", "g_xg_90"),
            )
        ),
    ),
    "view": f"""
        SELECT p.*, t.name AS team_name, {", ".join(f"s.{c}" for c in (*TOTALS, *DERIVED))}
        FROM players p LEFT JOIN teams t USING (team_id) LEFT JOIN season s USING (player_id)
    """,
}


def with_ctes(query: str, **extra: str) -> str:
    """``query`` behind the named selects it uses, directly or through others."""
    known = {**CTES, **extra}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(known[name])
                order.append(name)

    visit(query)
    return f"WITH {', '.join(f'{n} AS ({known[n]})' for n in order)} {query}" if order else query


_EVENT_SHOWN = "event_id, match_id, team_id, player_id, event_type, minute"


def _text_dates(source: str, *columns: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in columns)}) FROM {source}"


_SUMMED = (
    "goals", "assists", "minutes_played", "shots", "shots_on_target", "passes_attempted", "passes_completed",
    "key_passes", "tackles", "interceptions", "duels_won", "duels_lost", "fouls_committed", "yellow_cards", "red_cards",
)


def _team_summary(where: str = "") -> str:
    def mean(c: str) -> str:
        return f"ROUND(CAST(SUM(CAST(a.{c} AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(a.{c}), 2) AS avg_{c}"

    return f"""
        SELECT t.league, t.name AS team_name,
               {", ".join(mean(c) for c in ("age", "shot_accuracy", "pass_accuracy", "duel_win_rate"))},
               {", ".join(f"CAST(SUM(a.{c}) AS BIGINT) AS total_{c}" for c in _SUMMED)},
               {", ".join(f"ROUND(SUM(a.{c}), 2) AS total_{c}" for c in ("xg", "xa", "g_xg"))}
        FROM view a JOIN teams t ON a.team_id = t.team_id {where}
        GROUP BY t.team_id, t.name, t.league
    """


def _team_top(where: str = "") -> str:
    return f"""
        SELECT t.league, r.team_name, r.name AS player_name, r.position, r.age, r.minutes_played, r.goals, r.assists,
               r.goal_contribution
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY team_id ORDER BY goal_contribution DESC NULLS LAST, player_id)
                     AS ranking FROM view) r
        LEFT JOIN teams t ON r.team_id = t.team_id
        WHERE r.ranking <= 3 {where}
    """


def _search(*conditions: str, floors: bool = True, without: tuple[str, ...] = ()) -> str:
    tests = [f"{c} >= 0" for c in SEARCHABLE if floors and c not in without] + list(conditions)
    return f"SELECT * FROM view WHERE {' AND '.join(tests) or 'TRUE'}"


# --- quality -----------------------------------------------------------------------------------------------------------

def _missing(*columns: str) -> list[tuple[str, ...]]:
    return [("required", c, f"{c} IS NULL", "'value is missing'") for c in columns]


def _below(column: str, value: str | None = None) -> tuple[str, ...]:
    value = value or column
    return ("range", column, f"{value} < 0", f"'must be at least 0: ' || CAST({value} AS VARCHAR)")


def _between(column: str, low: int, high: int) -> tuple[str, ...]:
    return ("range", column, f"{column} < {low} OR {column} > {high}",
            f"'must be between {low} and {high}: ' || CAST({column} AS VARCHAR)")


def _layout(column: str) -> tuple[str, ...]:
    return ("date_layout", column, f"{column} IS NOT NULL AND {_checked(column)} IS NULL",
            f"'unreadable date, expected YYYY-MM-DD or DD/MM/YYYY: ' || {column}")


def _type(column: str, dtype: str, duck: str) -> tuple[str, ...]:
    return ("type", column, f"{column} IS NOT NULL AND TRY_CAST({column} AS {duck}) IS NULL",
            f"'not a {dtype}: ' || {column}")


def _over(rule: str, part: str, whole: str) -> tuple[str, ...]:
    return (rule, part, f"{part} > {whole}",
            f"'{part} ' || CAST({part} AS VARCHAR) || ' is more than {whole} ' || CAST({whole} AS VARCHAR)")


def _needs(rule: str, column: str, types: str, missing: str) -> tuple[str, ...]:
    return (rule, column, f"event_type IN ({types}) AND ({missing})",
            f"event_type || ' ' || event_id || ' has no {rule}'")


FIELD_RULES = {
    "teams": _missing("team_id", "name", "league", "stadium", "city"),
    "players": [
        *_missing("player_id", "name", "team_id", "position"), _layout("date_of_birth"), _layout("contract_until"),
        _type("market_value", "double", "DOUBLE"), _below("market_value", "TRY_CAST(market_value AS DOUBLE)"),
    ],
    "matches": [
        *_missing("match_id", "competition", "season", "match_date", "home_team_id", "away_team_id", "home_score",
                  "away_score", "venue", "attendance", "referee"),
        _type("attendance", "bigint", "BIGINT"), _below("home_score"), _below("away_score"),
        _below("attendance", "TRY_CAST(attendance AS BIGINT)"), _layout("match_date"),
    ],
    "player_match_stats": [
        *_missing("player_id", "match_id", *COUNTS, "xg", "xa"), *[_below(c) for c in COUNTS[:13]],
        _between("yellow_cards", 0, 2), _between("red_cards", 0, 1), _below("xg"), _below("xa"),
    ],
    "match_events": [
        *_missing("event_id", "match_id", "event_type", "player_id", "team_id", "outcome", "minute", "second",
                  "x_start", "y_start"),
        _below("minute"), _between("second", 0, 59),
        *[_between(c, 0, 100) for c in ("x_start", "y_start", "x_end", "y_end")],
    ],
}
CROSS_RULES = {
    "player_match_stats": [
        _over("shots_on_target", "shots_on_target", "shots"),
        _over("passes_completed", "passes_completed", "passes_attempted"),
        _over("xg_above_shots", "xg", "shots"),
    ],
    "match_events": [
        _needs("destination", "x_end", "'pass'", "x_end IS NULL OR y_end IS NULL"),
        _needs("pass_type", "pass_type", "'pass'", "pass_type IS NULL"),
        _needs("recipient", "recipient_id", "'pass'", "recipient_id IS NULL"),
        _needs("body_part", "body_part", "'pass', 'shot'", "body_part IS NULL"),
    ],
}
KEYS = {
    "teams": ("team_id",), "players": ("player_id",), "matches": ("match_id",),
    "player_match_stats": ("player_id", "match_id"), "match_events": ("event_id",),
}


def _failed(rules: list[tuple[str, ...]]) -> str:
    return " OR ".join(f"COALESCE(({r[2]}), FALSE)" for r in rules) or "FALSE"


def _violations(dataset: str) -> str:
    """All failures of all rows, with the rank of the failure in its row."""
    key = ", ".join(KEYS[dataset])
    field, cross = FIELD_RULES[dataset], CROSS_RULES.get(dataset, [])
    parts = [
        f"SELECT {key}, _seq, 'field' AS kind, '{rule}' AS rule, '{column}' AS \"column\", {message} AS message, "
        f"{i} AS rank FROM raw_{dataset} WHERE COALESCE(({test}), FALSE)"
        for i, (rule, column, test, message) in enumerate(field)
    ]
    for i, (rule, column, test, message) in enumerate(cross):
        earlier = _failed(cross[:i])
        parts.append(
            f"SELECT {key}, _seq, 'cross' AS kind, '{rule}' AS rule, '{column}' AS \"column\", {message} AS message, "
            f"{100 + i} AS rank FROM raw_{dataset} "
            f"WHERE NOT ({_failed(field)}) AND NOT ({earlier}) AND COALESCE(({test}), FALSE)"
        )
    return " UNION ALL ".join(parts)


def _invalid(dataset: str) -> str:
    return _failed([*FIELD_RULES[dataset], *CROSS_RULES.get(dataset, [])])


def _first(dataset: str) -> str:
    """First failure of each invalid row. Rows are told apart by a number: copies may agree in every column."""
    field, cross = FIELD_RULES[dataset], CROSS_RULES.get(dataset, [])
    tests = [*field, *cross]
    pick = " ".join(f"WHEN COALESCE(({t[2]}), FALSE) THEN {i}" for i, t in enumerate(tests))
    columns = " ".join(f"WHEN {i} THEN '{t[1]}'" for i, t in enumerate(tests))
    messages = " ".join(f"WHEN {i} THEN {t[3]}" for i, t in enumerate(tests))
    return (f"SELECT *, CASE hit {columns} END AS first_column, CASE hit {messages} END AS first_message "
            f"FROM (SELECT *, CASE {pick} END AS hit FROM raw_{dataset}) WHERE hit IS NOT NULL")


def _summary() -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, COUNT(*) AS total_rows, COUNT(*) - COUNT(*) FILTER ({_invalid(d)}) AS valid_rows, "
        f"COUNT(*) FILTER ({_invalid(d)}) AS invalid_rows, "
        f"(COUNT(*) - COUNT(*) FILTER ({_invalid(d)})) / COUNT(*) * 100 AS valid_percentage FROM raw_{d}"
        for d in KEYS
    )


_REFERENCES = (
    ("players", "team_id", "teams"), ("player_match_stats", "player_id", "players"),
    ("player_match_stats", "match_id", "matches"), ("match_events", "match_id", "matches"),
    ("match_events", "team_id", "teams"), ("match_events", "player_id", "players"),
)


def _orphans(child: str, column: str, parent: str) -> str:
    return (f"SELECT {column}, COUNT(*) AS n_rows FROM raw_{child} WHERE {column} IS NOT NULL AND {column} NOT IN "
            f"(SELECT {column} FROM raw_{parent}) GROUP BY {column}")


def _ambiguous(dataset: str, column: str) -> str:
    month, day = f"try_strptime(TRIM({column}), '%m/%d/%Y')", f"try_strptime(TRIM({column}), '%d/%m/%Y')"
    return (f"SELECT {column}, COUNT(*) AS n_rows FROM raw_{dataset} "
            f"WHERE {month} IS NOT NULL AND {day} IS NOT NULL AND {month} <> {day} GROUP BY {column}")


def _warnings() -> str:
    found = [(c, "orphan", column, _orphans(c, column, p)) for c, column, p in _REFERENCES]
    for d, key in KEYS.items():
        keys = ", ".join(key)
        grouped = f"SELECT {keys}, COUNT(*) AS n_rows FROM raw_{d} GROUP BY {keys} HAVING COUNT(*) > 1"
        found.append((d, "duplicate", "-".join(key), grouped))
    found.append(("players", "labels", "position", "SELECT position, COUNT(*) AS n_rows FROM raw_players GROUP BY position"))
    for d, c in (("players", "date_of_birth"), ("players", "contract_until"), ("matches", "match_date")):
        found.append((d, "ambiguous_date", c, _ambiguous(d, c)))
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, '{check}' AS \"check\", '{column}' AS \"column\", COUNT(*) AS n_keys, "
        f"CAST(SUM(n_rows) AS BIGINT) AS n_rows FROM ({query}) HAVING COUNT(*) > 0"
        for d, check, column, query in found
    )


_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NULL) AS null_count, "
    f"COUNT(*) FILTER ({c} IS NULL) / COUNT(*) * 100 AS null_percentage FROM raw_players"
    for c in ("market_value", "contract_until")
)


def _report() -> str:
    parts = [
        "SELECT dataset, 'rows' AS section, dataset AS item, printf('%d rows, %d correct (%.1f%%)', total_rows, "
        "valid_rows, valid_percentage) AS detail FROM report_summary",
        "SELECT dataset, 'warnings' AS section, \"check\" || ' ' || \"column\" AS item, "
        "printf('%d keys, %d rows', n_keys, n_rows) AS detail FROM report_warnings",
        "SELECT 'players' AS dataset, 'nulls' AS section, \"column\" AS item, "
        "printf('%d (%.1f%%)', null_count, null_percentage) AS detail FROM report_nulls",
    ]
    for child, column, parent in _REFERENCES:
        parts.append(f"SELECT '{child}' AS dataset, 'orphans' AS section, '{column} ' || {column} AS item, "
                     f"printf('%d rows', n_rows) AS detail FROM ({_orphans(child, column, parent)})")
    parts.append("SELECT 'players' AS dataset, 'labels' AS section, 'position ' || COALESCE(position, 'null') AS item, "
                 "printf('%d rows', COUNT(*)) AS detail FROM raw_players GROUP BY position")
    for d, key in KEYS.items():
        keys, joined = ", ".join(key), " || '-' || ".join(key)
        parts.append(f"SELECT '{d}' AS dataset, 'duplicates' AS section, COALESCE({joined}, 'null') AS item, "
                     f"printf('%d rows', COUNT(*)) AS detail FROM raw_{d} GROUP BY {keys} HAVING COUNT(*) > 1")
        item = " || '-' || ".join(f"COALESCE({c}, 'null')" for c in key)
        parts.append(f"SELECT '{d}' AS dataset, 'errors' AS section, {item} AS item, "
                     f"first_column || ' ' || first_message AS detail FROM ({_first(d)})")
    return with_ctes(" UNION ALL ".join(parts), report_summary=_summary(), report_warnings=_warnings(),
                     report_nulls=_NULLS)


# --- the same operators on the tables as they are ------------------------------------------------------------------------

_LINE_ORDER = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
               "l_linestatus", "l_shipdate")
_MONEY = "CAST(l_extendedprice AS DECIMAL(12, 2))"

_DELIVERED = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')
"""
_REPRICED = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders
    WHERE o_orderstatus IN ('O', 'P')
"""

NATIVE = {
    "supplier_season": """
        WITH season AS (
            SELECT l_suppkey,
                   CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
                   CAST(SUM(CAST(l_extendedprice AS DECIMAL(12, 2))) AS DOUBLE) AS revenue,
                   CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS returned,
                   CAST(SUM(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_lines,
                   CAST(SUM(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS shipped_lines
            FROM lineitem GROUP BY l_suppkey
        )
        SELECT s_suppkey AS supplier, n_name AS nation, quantity, revenue, returned, open_lines, shipped_lines,
               ROUND(CASE WHEN quantity > 0 THEN revenue / quantity * 90 END, 2) AS revenue_90,
               ROUND(CASE WHEN quantity > 0 THEN returned / quantity * 90 END, 2) AS returned_90,
               ROUND(CASE WHEN quantity > 0 THEN returned / quantity END, 2) AS return_rate,
               ROUND(CASE WHEN open_lines + shipped_lines > 0 THEN open_lines / (open_lines + shipped_lines) END, 2)
                   AS open_share
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN season ON s_suppkey = l_suppkey
    """,
    "keep_last_lineitem": f"""
        SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem
        QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY {", ".join(f"{c} DESC NULLS LAST" for c in _LINE_ORDER)}) = 1
    """,
    "duplicate_lineitem_keys": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_key, COUNT(*) AS n_rows
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
    """,
    "semi_lineitem_open_orders": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
          AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25)
    """,
    "orphan_lineitem_rows": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """,
    "orphan_event_users": """
        SELECT user_id, COUNT(*) AS n_rows FROM events
        WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY user_id
    """,
    "null_profile_events": """
        WITH parsed AS (
            SELECT CASE WHEN value > 100 THEN NULL ELSE value END AS value,
                   CASE WHEN event_type = 'error' THEN NULL ELSE props END AS props FROM events
        )
        SELECT 'value' AS "column", COUNT(*) FILTER (value IS NULL) AS null_count,
               COUNT(*) FILTER (value IS NULL) / COUNT(*) * 100 AS null_percentage FROM parsed
        UNION ALL
        SELECT 'props', COUNT(*) FILTER (props IS NULL), COUNT(*) FILTER (props IS NULL) / COUNT(*) * 100 FROM parsed
    """,
    "label_census_part_type": "SELECT p_type, COUNT(*) AS n_rows FROM part GROUP BY p_type",
    "validity_lineitem": """
        SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (l_discount <= l_tax) AS valid_rows,
               COUNT(*) FILTER (l_discount > l_tax) AS invalid_rows,
               COUNT(*) FILTER (l_discount <= l_tax) / COUNT(*) * 100 AS valid_percentage FROM lineitem
    """,
    "null_out_prices": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_discount < 0.02 OR l_discount > l_tax THEN NULL ELSE l_discount END
               AS l_discount FROM lineitem
    """,
    "normalize_segments": """
        SELECT c_custkey, CASE WHEN LOWER(c_mktsegment) IN ('furniture', 'household') THEN 'Home'
                               WHEN LOWER(c_mktsegment) IN ('machinery', 'automobile') THEN 'Engines'
                               ELSE 'Other' END AS segment FROM customer
    """,
    # Doubles from 2 ** -8 up are whole multiples of 2 ** -60; a sum of two exact parts is rounded once.
    "exact_price_totals": """
        WITH units AS (
            SELECT l_returnflag, l_linestatus, SUM(CAST(l_extendedprice * pow(2, 60) AS HUGEINT)) AS gross,
                   SUM(CAST(l_extendedprice * (1 - l_discount) * pow(2, 60) AS HUGEINT)) AS net,
                   COUNT(l_extendedprice) AS n_gross, COUNT(l_extendedprice * (1 - l_discount)) AS n_net
            FROM lineitem GROUP BY ALL
        ), sums AS (
            SELECT *, (CAST(gross // 1125899906842624 AS DOUBLE) * pow(2, 50) + CAST(gross % 1125899906842624 AS DOUBLE)) / pow(2, 60) AS s_gross,
                   (CAST(net // 1125899906842624 AS DOUBLE) * pow(2, 50) + CAST(net % 1125899906842624 AS DOUBLE)) / pow(2, 60) AS s_net
            FROM units
        )
        SELECT l_returnflag, l_linestatus, s_gross AS sum_l_extendedprice, s_gross / n_gross AS mean_l_extendedprice,
               n_gross AS count_l_extendedprice, s_net AS sum_net, s_net / n_net AS mean_net, n_net AS count_net
        FROM sums
    """,
    "dates_by_evidence": """
        SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day_first,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS month_first
        FROM orders
    """,
    "normalize_order_dates": """
        WITH written AS (
            SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
                                                  WHEN 'O' THEN strftime(o_orderdate, ' %d/%m/%Y ')
                                                  ELSE strftime(o_orderdate, '%Y/%m/%d') END AS written FROM orders
        )
        SELECT o_orderkey,
               CAST(CAST(COALESCE(try_strptime(TRIM(written), '%Y-%m-%d'), try_strptime(TRIM(written), '%Y/%m/%d'),
                    try_strptime(TRIM(written), '%m/%d/%Y'), try_strptime(TRIM(written), '%d/%m/%Y')) AS DATE) AS VARCHAR)
                   AS month_first,
               CAST(CAST(COALESCE(try_strptime(TRIM(written), '%Y-%m-%d'), try_strptime(TRIM(written), '%Y/%m/%d'),
                    try_strptime(TRIM(written), '%d/%m/%Y'), try_strptime(TRIM(written), '%m/%d/%Y')) AS DATE) AS VARCHAR)
                   AS day_first
        FROM written
    """,
    "order_age": f"SELECT o_orderkey, {_age('CAST(o_orderdate AS DATE)')} AS age FROM orders",
    "top3_orders_per_customer": """
        SELECT o_custkey, o_orderkey, o_totalprice, CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey
               ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS INTEGER) AS ranking
        FROM orders QUALIFY ranking <= 3
    """,
    "range_search_lineitem": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_extendedprice FROM lineitem
        WHERE l_quantity >= 10 AND l_quantity <= 30 AND l_discount >= 0.05 AND l_extendedprice <= 50000
          AND l_returnflag = 'R'
    """,
    "json_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "json_array_rows": """
        SELECT l_orderkey, l_linenumber, 'quantity' AS measure, l_quantity AS amount FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber, 'price', l_extendedprice FROM lineitem
    """,
    "union_accounts": """
        SELECT 'customer' AS kind, c_custkey AS account, c_nationkey AS nation, c_acctbal AS balance FROM customer
        UNION ALL SELECT 'supplier', s_suppkey, s_nationkey, s_acctbal FROM supplier
    """,
    "upsert_orders": f"""
        WITH existing AS ({_DELIVERED}), incoming AS ({_REPRICED})
        SELECT * FROM existing WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming)
        UNION ALL SELECT * FROM incoming
    """,
}

# DuckDB has no crc32: the bytes of the key's digits go through the checksum's table, built here by its rule.
NATIVE["upsert_orders_partitions"] = """
    WITH steps AS (
        SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
                    ORDER BY i) AS t
        FROM range(256) r(i)
    ), placed AS (
        SELECT o_custkey, o_totalprice, xor(list_reduce(
            list_transform(range(1, length(k) + 1), lambda p: ascii(substr(k, p, 1))::BIGINT),
            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 64 AS bucket
        FROM (SELECT *, o_orderkey::VARCHAR AS k FROM orders), steps
    ), customer_one AS (
        SELECT min(o_custkey) AS c FROM orders
    )
    SELECT bucket::INTEGER AS bucket, count(*) AS n_rows,
           sum(round(CASE WHEN o_custkey = c THEN o_totalprice * 2 ELSE o_totalprice END * 100)::BIGINT)::BIGINT AS cents,
           CASE WHEN count(*) FILTER (o_custkey = c) > 0 THEN count(*) ELSE 0 END AS n_written
    FROM placed, customer_one GROUP BY bucket
"""


def oracle_sql() -> dict[str, str]:
    players = with_ctes(_text_dates("c_players", "date_of_birth", "contract_until"))
    raw = {d: with_ctes(f"SELECT * EXCLUDE (_seq) FROM raw_{d}") for d in KEYS}
    view_dates = ("date_of_birth", "contract_until")

    def viewed(query: str) -> str:
        return with_ctes(_text_dates(f"({query})", *view_dates))

    bounded = _search("minutes_played >= 500", "minutes_played <= 2500", "goals <= 12", "pass_accuracy >= 0.8",
                      "position = 'Forward'", without=("g_xg", "g_xg_90", "minutes_played", "pass_accuracy"))
    queries = {
        "clean_teams": with_ctes("SELECT * EXCLUDE (_seq) FROM c_teams"),
        "clean_players": players,
        "clean_matches": with_ctes(_text_dates("(SELECT * EXCLUDE (_seq) FROM c_matches)", "match_date")),
        "clean_player_match_stats": with_ctes("SELECT * FROM c_stats"),
        "clean_match_events": with_ctes("SELECT * EXCLUDE (_seq) FROM c_events"),
        "clean_match_events_stored": with_ctes("SELECT * EXCLUDE (_seq) FROM c_events"),
        "player_view": viewed("SELECT * FROM view"),
        "player_view_sql": viewed("SELECT * FROM view"),
        "stored_player_view": viewed("SELECT * FROM view"),
        "range_search_default": viewed(_search()),
        "range_search_default_sql": viewed(_search()),
        "range_search_bounded": viewed(bounded),
        "range_search_bounded_sql": viewed(bounded),
        "range_search_open": viewed(_search("age <= 30", floors=False)),
        "profile_effective_scorers": with_ctes(
            "SELECT name, team_name, age, position, minutes_played, goals, g_xg FROM ("
            + _search("goals >= 5", "g_xg >= 2") + ")"),
        "profile_defensive_midfielders": with_ctes(
            "SELECT name, team_name, age, minutes_played, pass_accuracy, interceptions_90, duel_win_rate FROM ("
            + _search("position = 'Midfielder'", "pass_accuracy >= 0.75", "interceptions_90 >= 3",
                      "duel_win_rate >= 0.5") + ")"),
        "profile_creative_attackers": with_ctes(
            "SELECT name, team_name, age, minutes_played, key_passes_90, goal_contribution_90 FROM ("
            + _search("key_passes_90 >= 2", "goal_contribution_90 >= 0.5") + ")"),
        "team_summary": with_ctes(_team_summary()),
        "team_summary_sql": with_ctes(_team_summary()),
        "team_summary_one": with_ctes(_team_summary("WHERE a.team_id = 'T3'")),
        "team_summary_one_sql": with_ctes(_team_summary("WHERE a.team_id = 'T3'")),
        "top3_per_team": with_ctes(_team_top()),
        "top3_per_team_sql": with_ctes(_team_top()),
        "top3_one_team": with_ctes(_team_top("AND r.team_id = 'T3'")),
        "top3_one_team_sql": with_ctes(_team_top("AND r.team_id = 'T3'")),
        "top3_csv_report": with_ctes(_team_top()),
        "quality_summary": with_ctes(_summary()),
        "quality_warnings": with_ctes(_warnings()),
        "quality_report": _report(),
        "season_after_corrections": with_ctes("SELECT * FROM season"),
        "quality_summary_deliveries": with_ctes(_summary()),
        "quality_warnings_deliveries": with_ctes(_warnings()),
        "quality_report_deliveries": _report(),
        "null_profile_players": with_ctes(_NULLS),
        "label_census_positions": with_ctes("SELECT position, COUNT(*) AS n_rows FROM raw_players GROUP BY position"),
        "duplicate_stats": with_ctes(
            "SELECT player_id || '-' || match_id AS duplicate_key, COUNT(*) AS n_rows FROM raw_player_match_stats "
            "GROUP BY player_id, match_id HAVING COUNT(*) > 1"),
        "contract_players_quarantined": with_ctes(_text_dates(
            "(SELECT * FROM c_players WHERE player_id NOT IN (SELECT player_id FROM players))", *view_dates)),
        "contract_stats_kept": with_ctes("SELECT * FROM stats"),
        "upsert_players": with_ctes(
            _text_dates("(SELECT * FROM first_players WHERE player_id NOT IN (SELECT player_id FROM later_players) "
                        "UNION ALL SELECT * FROM later_players)", *view_dates),
            first_players=_delivery(1), later_players=_delivery(2)),
        "landed_csv_players": raw["players"],
        "landed_json_events": raw["match_events"],
        "landed_json_matches": with_ctes(
            "SELECT * EXCLUDE (_seq) REPLACE (TRY_CAST(attendance AS BIGINT) AS attendance) FROM raw_matches"),
        "second_delivery_players": with_ctes("SELECT * EXCLUDE (_seq) FROM raw_players WHERE _seq = 2"),
        "streamed_csv_players": raw["players"],
        "late_parents_events": with_ctes(
            f"SELECT {_EVENT_SHOWN}, 'kept' AS state FROM c_events WHERE y_start IS NOT NULL AND outcome IS NOT NULL "
            f"UNION ALL SELECT {_EVENT_SHOWN}, 'waiting' AS state FROM late_events"),
    }
    queries["streamed_players_table"] = queries["upsert_players"]
    for d, key in KEYS.items():
        columns = f"{', '.join(key)}, kind, rule, \"column\", message"
        queries[f"violations_{d}"] = with_ctes(f"SELECT {columns} FROM ({_violations(d)})")
    for child, column, parent in _REFERENCES:
        queries[f"orphans_{child}_{parent}"] = with_ctes(_orphans(child, column, parent))
    return queries | NATIVE


def _delivery(seq: int) -> str:
    """Players of one delivery, cleaned on their own, under the table contract."""
    return f"""
        SELECT * REPLACE (CAST(market_value AS INTEGER) AS market_value) FROM (
            SELECT *, {_age("date_of_birth")} AS age FROM (
                SELECT player_id, name, team_id, {_POSITION} AS position, {_date("date_of_birth")} AS date_of_birth,
                       nationality, TRY_CAST(market_value AS DOUBLE) AS market_value,
                       {_date("contract_until")} AS contract_until
                FROM raw_players WHERE _seq = {seq} AND team_id IN (SELECT team_id FROM c_teams)
            )
        ) WHERE name IS NOT NULL AND date_of_birth IS NOT NULL AND nationality IS NOT NULL
    """
