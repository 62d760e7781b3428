"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads. Each query runs whole: its result goes to Spark's
``noop`` sink, so all rows and columns are computed and none reach the driver. ``queries`` holds the best of the warm
runs, ``cold`` the first run.
"""

from __future__ import annotations

import json
import os
import time

from statline.catalog.queries import QUERIES
from statline.session import build_session

HEADLINE = (
    "player_view", "player_view_sql", "range_search_default", "profile_effective_scorers", "team_summary",
    "top3_per_team", "clean_players", "clean_matches", "clean_player_match_stats", "clean_match_events",
    "violations_player_match_stats", "violations_match_events", "quality_summary", "quality_warnings",
    "upsert_players", "supplier_season", "keep_last_lineitem", "duplicate_lineitem_keys", "semi_lineitem_open_orders",
    "orphan_lineitem_rows", "validity_lineitem", "normalize_order_dates", "top3_orders_per_customer",
    "range_search_lineitem", "json_array_rows", "upsert_orders",
)
WARM_RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    cold = {name: seconds(name) for name in HEADLINE}
    warm = {name: min(seconds(name) for _ in range(WARM_RUNS)) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "total warm seconds of the headline queries", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
