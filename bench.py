"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all) choose data and cores.
Every query starts from the parquet tables and is run to its last row.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import queries  # noqa: E402

HEADLINE = (
    "stg_events",
    "stg_sessions",
    "dim_users",
    "fact_revenue",
    "fact_levels",
    "rolling_active",
    "mart_daily_kpis",
    "mart_retention_cohorts",
    "mart_revenue_daily",
    "mart_player_segments",
    "mart_session_stats",
    "mart_level_funnel",
    "mart_geo_stats",
    "level_funnel_enriched",
    "ltv_curves",
    "score_distribution",
    "feature_store",
    "assign_segments",
    "segment_stats",
    "binary_metrics",
    "global_row_number",
    "distributed_ntile",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("playerlens-bench")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_PARTITIONS", "8"))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="playerlens-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    available = queries()
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # starts the session's machinery
    chosen = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in chosen:
        started = time.perf_counter()
        available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
