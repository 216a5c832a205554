"""Daily load of attribution reports from the landing zone."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from playerlens import schemas
from playerlens.sinks.tables import days_of, dedup_stored, expire_partitions, load_raw, table_path
from playerlens.sources.normalize import normalise_report
from playerlens.sources.readers import read_landing


def daily_ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    day: date,
    source: str = "landing",
    loaded_at: datetime | None = None,
    keep_days: int | None = None,
) -> dict[str, dict]:
    """Loads the five reports of ``day``, then deduplicates every day their rows belong to.

    A report that fails is noted and the others go on. Rows delivered late have an earlier day of
    their own, and loading a day again is harmless for those too: later copies replace earlier ones.
    ``keep_days`` also drops the days that have become too old.
    """
    results: dict[str, dict] = {}
    touched: dict[str, list[DataFrame]] = {}
    for report_type, table in schemas.REPORT_TARGETS.items():
        try:
            report = read_landing(spark, landing, report_type, day)
            batch = normalise_report(report, table.schema, source, loaded_at)
            rows = load_raw(batch, table_path(root, "raw", table.name), table)
            results[report_type] = {"status": "success", "rows": rows}
            if rows:
                touched.setdefault(table.name, []).append(days_of(batch, table))
        except Exception as problem:  # noqa: BLE001 - reported per report
            results[report_type] = {"status": "error", "error": str(problem)}
    for name, days in touched.items():
        try:
            loaded = reduce(DataFrame.union, days).distinct()
            kept = dedup_stored(
                spark, table_path(root, "raw", name), schemas.RAW_TABLES[name], loaded
            )
            results[name] = {"status": "deduplicated", "rows": kept}
            if keep_days is not None:
                path = table_path(root, "raw", name)
                results[name]["expired"] = expire_partitions(spark, path, day, keep_days)
        except Exception as problem:  # noqa: BLE001 - rows stay, repeated, until the next run
            results[name] = {"status": "error", "error": str(problem)}
    return results
