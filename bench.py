"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8)
the cores, BENCH_QUERIES an optional comma-separated choice of queries, BENCH_RUNS how often
each is run (the median counts), BENCH_SHARED the folder for tables and checkpoints.
Every query is run to its last row; what a query does while it is built (a merge into a
table, say) is timed with it and also given apart, as ``setup``. The first run of a small
query warms the session up.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from statistics import median

from clickloom.queries import QUERIES
from clickloom.session import build_session

#: Seconds after which a query is not repeated.
LONG = 15

HEADLINE = (
    "identity_map",
    "param_lookup",
    "explode_items",
    "backfill_user",
    "view_item_events",
    "add_to_cart_events",
    "add_to_wishlist_events",
    "dedupe_row_number",
    "merge_view_events",
    "merge_cart_events",
    "merge_wishlist_events",
    "purchase_data",
    "merge_purchases",
    "view_data",
    "cart_data",
    "wishlist_data",
    "merge_facts",
    "interaction_union",
    "merge_interactions",
    "interaction_export",
    "item_train",
    "merge_items",
    "user_train",
    "day_reload",
    "merge_into_table",
    "interaction_csv",
    "two_day_run",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    shared = os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__sql__warehouse__dir=f"{shared}/warehouse",
        spark__checkpoint__dir=f"{shared}/checkpoints",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> tuple[float, float]:
        """Seconds in all, and until the query was built."""
        start = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        built = time.perf_counter() - start
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start, built

    run("gate_event")
    times, setup = {}, {}
    for name in names:
        both = [run(name)]
        # Long queries vary little from run to run; once must do.
        while len(both) < runs and sum(x[0] for x in both) < LONG:
            both.append(run(name))
        times[name], setup[name] = (round(median(x), 3) for x in zip(*both, strict=True))
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "setup": setup, "sf": sf_dir}))


if __name__ == "__main__":
    main()
