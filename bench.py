"""Times the headline queries and prints one JSON line.

The stored history is built first and timed on its own; all other queries read the given
tables.  Scratch data goes to a folder of this run, which is removed at the end.  Every query runs once cold and twice warm on a noop sink, which computes all
rows and columns; ``queries`` holds the best warm time, ``cold`` the first run.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tickforge.plans.queries import QUERIES, stored_bars  # noqa: E402
from tickforge.session import build_session  # noqa: E402

HEADLINE = [
    "v01_daily_analysis",
    "v02_monthly_analysis",
    "v03_increment_daily_analysis",
    "v06_intraday",
    "v07_moving_averages",
    "v09_market_overview",
    "a01_daily_volume_max",
    "a04_market_volume",
    "a05_monthly_volume",
    "a08_record_volume_day",
    "a09_ohlc_bars",
    "a13_monthly_distribution",
    "a14_symbol_statistics",
    "a16_sparse_rows_merged",
    "f03_clean_history",
    "j01_daily_outer_join",
    "t02_newest_rows",
    "t05_page",
    "w01_latest_snapshot",
    "w02_deduplicated",
    "w04_close_streaks",
    "w08_intraday_vwap",
    "w11_moving_average_crosses",
]
WARM_RUNS = 2


def timed(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__checkpoint__dir=shared,
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    start = time.perf_counter()
    stored_bars(spark, sf_dir)
    cold["build_history"] = warm["build_history"] = round(time.perf_counter() - start, 3)
    for name in names:
        run = QUERIES[name]
        cold[name] = round(timed(run(spark, sf_dir)), 3)
        warm[name] = round(min(timed(run(spark, sf_dir)) for _ in range(WARM_RUNS)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()
    shutil.rmtree(shared, ignore_errors=True)


if __name__ == "__main__":
    main()
