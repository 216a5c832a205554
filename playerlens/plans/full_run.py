"""Explore, ingest, transform, ml and verify, one after the other.

    spark-submit -m playerlens.plans.full_run --source <nested events> --root <tables> --run all
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date, datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from playerlens.operators import profiling, quality
from playerlens.plans.churn_job import churn_job, ml_path
from playerlens.plans.layers import BY_NAME, open_table, run_layers
from playerlens.session import prepare_for_tables, side_by_side
from playerlens.settings import Settings
from playerlens.sinks.tables import read_table, table_path, write_table
from playerlens.sources.normalize import flatten_events
from playerlens.sources.readers import read_event_shards

STEPS = ("explore", "ingest", "transform", "ml", "verify")


def explore(spark: SparkSession, source: str, settings: Settings) -> dict:
    nested = read_event_shards(spark, source, settings.date_from, settings.date_to)
    return {
        "date_range": profiling.source_summary(nested),
        "event_names": profiling.event_name_counts(nested),
        "platforms": profiling.platform_counts(nested),
        "top_countries": profiling.top_countries(nested),
        "param_keys": profiling.top_param_keys(nested),
    }


def ingest(
    spark: SparkSession,
    source: str,
    root: str,
    date_from: date | None = None,
    date_to: date | None = None,
    overwrite: bool = True,
    loaded_at: datetime | None = None,
) -> dict:
    """Flattens the shards of a date range into ``raw_events``.

    ``overwrite`` replaces the days that are loaded and leaves others; without it rows are added
    and staging keeps the newest copy of each.
    """
    flat = flatten_events(read_event_shards(spark, source, date_from, date_to), loaded_at)
    rows = write_table(
        flat,
        table_path(root, "raw", "raw_events"),
        "overwrite" if overwrite else "append",
        "event_date",
        ("event_name", "platform", "geo_country"),
        only_partitions=overwrite,
    )
    return {"rows_loaded": rows, "date_from": date_from, "date_to": date_to}


def verify(spark: SparkSession, root: str):
    """Summaries of all tables that are there; a missing one is left out of them."""
    tables = {}
    for name in ("raw_events", *BY_NAME):
        try:
            tables[name] = open_table(spark, root, name)
        except AnalysisException:
            continue
    try:
        tables["feature_store"] = read_table(spark, ml_path(root, "feature_store"))
    except AnalysisException:
        pass
    return quality.verify_layers(tables)


def summaries_path(root: str) -> str:
    return table_path(root, "marts", "verify_summaries")


def run(
    spark: SparkSession,
    source: str,
    root: str,
    steps: tuple[str, ...] = STEPS,
    settings: Settings = Settings(),
    mode: str = "predict",
    now: datetime | None = None,
) -> dict[str, dict]:
    """Runs the given steps in their fixed order and stops at the first one that fails."""
    unknown = [s for s in steps if s not in STEPS]
    if unknown:
        raise ValueError(f"unknown steps: {', '.join(unknown)}")

    def transform() -> dict:
        report = run_layers(spark, root, settings=settings)
        bad = [n for n, r in report.items() if r["status"] != "success"]
        if bad:
            raise RuntimeError(f"tables not built: {', '.join(bad)}: {report}")
        return report

    def explored() -> dict:
        profiles = explore(spark, source, settings)
        stores = [
            partial(write_table, profile, table_path(root, "raw", f"profile_{name}"))
            for name, profile in profiles.items()
        ]
        return dict(zip(profiles, side_by_side(spark, *stores)))

    def verified() -> list:
        """The summaries, which are stored too, so that readers need not make them again."""
        write_table(verify(spark, root).coalesce(1), summaries_path(root))
        return read_table(spark, summaries_path(root)).collect()

    actions: dict[str, Callable[[], object]] = {
        "explore": explored,
        "ingest": lambda: ingest(
            spark, source, root, settings.date_from, settings.date_to, loaded_at=now
        ),
        "transform": transform,
        "ml": lambda: churn_job(spark, root, mode, settings, now),
        "verify": verified,
    }
    results: dict[str, dict] = {}
    for step in STEPS:
        if step not in steps:
            continue
        try:
            results[step] = {"status": "success", "result": actions[step]()}
        except Exception as problem:  # noqa: BLE001 - reported; later steps do not run
            results[step] = {"status": "error", "error": str(problem)}
            break
    return results


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--source", required=True, help="folder of suffix=YYYYMMDD/ shards")
    parser.add_argument("--root", required=True, help="folder of the stored tables")
    parser.add_argument("--run", default="all", help="comma-separated steps, or all")
    parser.add_argument("--mode", default="predict", choices=("predict", "retrain"))
    parser.add_argument("--date-from", type=date.fromisoformat, default=Settings.date_from)
    parser.add_argument("--date-to", type=date.fromisoformat, default=Settings.date_to)
    parser.add_argument("--ref-date", type=date.fromisoformat, default=None)
    args = parser.parse_args(argv)

    settings = Settings(
        ref_date=args.ref_date or args.date_to, date_from=args.date_from, date_to=args.date_to
    )
    spark = prepare_for_tables(SparkSession.builder.appName("playerlens").getOrCreate())
    steps = STEPS if args.run == "all" else tuple(args.run.split(","))
    results = run(spark, args.source, args.root, steps, settings, args.mode)
    for step, outcome in results.items():
        print(f"{step}: {outcome['status']} {outcome.get('error', '')}".rstrip())
    return 0 if all(r["status"] == "success" for r in results.values()) else 1


if __name__ == "__main__":
    raise SystemExit(main())
