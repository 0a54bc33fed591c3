"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query is run once to warm
up and then timed BENCH_REPEAT times; the best time counts. Results go to Spark's no-op sink, so
all rows are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidepool import fixtures as X  # noqa: E402
from tidepool.catalog import QUERIES  # noqa: E402
from tidepool.operators.features import pool_features  # noqa: E402
from tidepool.operators.labels import label_spikes  # noqa: E402
from tidepool.operators.quantiles import exact_quantiles  # noqa: E402
from tidepool.session import build_session  # noqa: E402

REGISTERED = [
    "f11_pool_features", "d2_label_spikes", "f12_time_features", "f8_ffill_bfill", "f10_dedup_latest",
    "e6_describe", "e7_pool_quality", "e11_resample_daily", "d5_missing_hours_by_pool", "e20_corr_matrix",
    "c4_cut_above_quantile", "b4_stage_pool_hourly", "k4_run_stages", "i7_decompose_by_pool", "j4_score",
    "l3_rollup_hourly",
]


def _supplier(make):
    return lambda spark, sf: make(X.supplier_days(spark, sf))


# the larger series: suppliers as pools, ship dates as hours, and chunks of as many rows as 90 days of hours
CHUNK = 2160 * 86_400
LARGER = {
    "supplier_features": _supplier(lambda df: pool_features(df, chunk_seconds=CHUNK)),
    "supplier_labels": _supplier(lambda df: label_spikes(df, unique_hours=True)),
    "supplier_quantiles": _supplier(lambda df: exact_quantiles(df, "volume_usd", [0.25, 0.5, 0.75], ["pool_id"])),
    "lineitem_quantile_by_counting": lambda spark, sf: exact_quantiles(
        X.table(spark, sf, "lineitem"), "l_extendedprice", [0.5, 0.999], direct_limit=0
    ),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    todo = {**{name: QUERIES[name] for name in REGISTERED}, **LARGER}
    times: dict[str, float] = {}
    for name, query in todo.items():
        best = None
        for run in range(repeat + 1):
            started = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            if run:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    pool_hours = X.pool_hourly(spark, sf_dir).agg(F.count("*")).first()[0]
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "pool_hours": pool_hours,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
