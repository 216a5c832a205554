"""The tables of a run, what each is built from, and a runner over them."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from playerlens.operators import activity, marts, sketches, staging, warehouse
from playerlens.operators.funnel import level_funnel_enriched
from playerlens.settings import Settings
from playerlens.sinks.tables import (
    create_layers,
    read_table,
    register_table,
    table_path,
    write_table,
)

Inputs = dict[str, DataFrame]


@dataclass(frozen=True)
class TablePlan:
    name: str
    layer: str
    inputs: tuple[str, ...]
    build: Callable[[SparkSession, Inputs, Settings], DataFrame]
    partition: str | None = None
    cluster: tuple[str, ...] = ()
    # Looks values up in its inputs while it is built, so its plan cannot be had without a run.
    looks_up: bool = False


RAW_EVENTS = ("raw", "raw_events")

# In an order in which every table comes after its inputs.
TABLES: tuple[TablePlan, ...] = (
    TablePlan(
        "stg_events",
        "staging",
        ("raw_events",),
        lambda spark, t, s: staging.stg_events(t["raw_events"]),
        "event_date",
        ("event_name", "platform", "geo_country"),
    ),
    TablePlan(
        "stg_sessions",
        "staging",
        ("stg_events",),
        lambda spark, t, s: staging.stg_sessions(
            t["stg_events"], s.session_gap_minutes, s.event_names
        ),
        "session_date",
        ("platform", "geo_country"),
    ),
    TablePlan(
        "dim_dates",
        "warehouse",
        (),
        lambda spark, t, s: warehouse.dim_dates(spark, s.calendar_from, s.calendar_to),
    ),
    TablePlan(
        "dim_users",
        "warehouse",
        ("stg_events",),
        lambda spark, t, s: warehouse.dim_users(t["stg_events"], s.ref_date),
    ),
    TablePlan(
        "fact_events",
        "warehouse",
        ("stg_events",),
        lambda spark, t, s: warehouse.fact_events(t["stg_events"]),
        "event_date",
        ("event_name", "platform"),
    ),
    TablePlan(
        "fact_sessions",
        "warehouse",
        ("stg_sessions",),
        lambda spark, t, s: warehouse.fact_sessions(t["stg_sessions"]),
        "session_date",
        ("platform", "geo_country"),
    ),
    TablePlan(
        "fact_revenue",
        "warehouse",
        ("stg_events",),
        lambda spark, t, s: warehouse.fact_revenue(t["stg_events"]),
        "event_date",
        ("revenue_type", "platform"),
    ),
    TablePlan(
        "fact_levels",
        "warehouse",
        ("stg_events",),
        lambda spark, t, s: warehouse.fact_levels(t["stg_events"]),
        "event_date",
        ("level_number",),
    ),
    TablePlan(
        "player_activity",
        "warehouse",
        ("stg_events",),
        lambda spark, t, s: activity.activity_bitmaps(t["stg_events"]),
        activity.SPAN,
    ),
    TablePlan(
        "mart_daily_kpis",
        "marts",
        ("fact_events", "fact_sessions", "dim_users"),
        lambda spark, t, s: marts.mart_daily_kpis(
            t["fact_events"], t["fact_sessions"], t["dim_users"], s.active_window_days
        ),
    ),
    TablePlan(
        "mart_retention_cohorts",
        "marts",
        ("dim_users", "fact_events"),
        lambda spark, t, s: marts.mart_retention_cohorts(t["dim_users"], t["fact_events"]),
    ),
    TablePlan(
        "mart_revenue_daily",
        "marts",
        ("fact_revenue",),
        lambda spark, t, s: marts.mart_revenue_daily(t["fact_revenue"]),
    ),
    TablePlan(
        "mart_player_segments",
        "marts",
        ("dim_users",),
        lambda spark, t, s: marts.mart_player_segments(t["dim_users"]),
        looks_up=True,
    ),
    TablePlan(
        "mart_session_stats",
        "marts",
        ("fact_sessions",),
        lambda spark, t, s: marts.mart_session_stats(t["fact_sessions"]),
    ),
    TablePlan(
        "mart_level_funnel",
        "marts",
        ("fact_levels", "dim_users"),
        lambda spark, t, s: marts.mart_level_funnel(t["fact_levels"], t["dim_users"]),
    ),
    TablePlan(
        "mart_geo_stats",
        "marts",
        ("dim_users",),
        lambda spark, t, s: marts.mart_geo_stats(t["dim_users"]),
    ),
    TablePlan(
        "mart_level_funnel_enriched",
        "marts",
        ("mart_level_funnel",),
        lambda spark, t, s: level_funnel_enriched(t["mart_level_funnel"]),
    ),
    TablePlan(
        "day_activity",
        "marts",
        ("fact_events",),
        lambda spark, t, s: sketches.day_activity(t["fact_events"]),
    ),
    TablePlan(
        "day_sessions",
        "marts",
        ("fact_sessions",),
        lambda spark, t, s: sketches.day_sessions(t["fact_sessions"]),
    ),
    TablePlan(
        "day_scores",
        "marts",
        ("fact_levels",),
        lambda spark, t, s: sketches.day_scores(t["fact_levels"]),
    ),
)
BY_NAME = {t.name: t for t in TABLES}
RUN_LAYERS = ("staging", "warehouse", "marts")


def stored_path(root: str, name: str) -> str:
    layer = BY_NAME[name].layer if name in BY_NAME else RAW_EVENTS[0]
    return table_path(root, layer, name)


def open_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, stored_path(root, name))


def run_layers(
    spark: SparkSession,
    root: str,
    layer: str = "all",
    dry_run: bool = False,
    settings: Settings = Settings(),
    register: str | None = None,
    only: Sequence[str] | None = None,
    at_once: int = 8,
) -> dict[str, dict]:
    """Builds and stores the tables of one layer or of all, from the tables stored below ``root``.

    Each table is stored once and its dependents read it back. Up to ``at_once`` tables are built at the
    same time, each as soon as its inputs are stored. A failed table does not stop the
    run, but tables that need it are skipped rather than built on what an earlier run left. A dry
    run reports the optimised plans and runs none. With ``register``, a prefix, the layers' namespaces
    are created and every stored table can be read as ``prefix_layer.table``. ``only`` names the tables
    to build, if not all of the layer.
    """
    if layer != "all" and layer not in RUN_LAYERS:
        raise ValueError(f"unknown layer {layer!r}; one of {', '.join(RUN_LAYERS)}, all")
    if register and not dry_run:
        create_layers(spark, register)
    planned: dict[str, DataFrame | None] = {}
    outcomes: dict[str, Future[dict]] = {}

    def build(plan: TablePlan) -> dict:
        # Tables begin in the order of ``TABLES``, so the inputs waited for are done or under way.
        before = {name: outcomes[name].result() for name in plan.inputs if name in outcomes}
        missing = sorted(n for n, r in before.items() if r["status"] in ("error", "skipped"))
        if missing:
            return {"status": "skipped", "because_of": missing}
        started = time.monotonic()
        try:
            if dry_run:
                planned[plan.name] = _planned(spark, root, plan, planned, settings)
                return {"status": "dry_run", "plan": _plan_text(planned[plan.name])}
            inputs = {name: open_table(spark, root, name) for name in plan.inputs}
            df = plan.build(spark, inputs, settings)
            rows = write_table(
                df, stored_path(root, plan.name), "overwrite", plan.partition, plan.cluster
            )
            if register:
                path = stored_path(root, plan.name)
                register_table(spark, path, plan.layer, plan.name, register)
            return {
                "status": "success",
                "rows": rows,
                "seconds": round(time.monotonic() - started, 1),
            }
        except Exception as problem:  # noqa: BLE001 - reported, and dependents are skipped
            return {"status": "error", "error": str(problem)}

    chosen = [t for t in TABLES if layer in ("all", t.layer) and (only is None or t.name in only)]
    with ThreadPoolExecutor(1 if dry_run else at_once) as pool:
        for plan in chosen:
            outcomes[plan.name] = pool.submit(inheritable_thread_target(spark)(build), plan)
    return {name: outcome.result() for name, outcome in outcomes.items()}


def _planned(
    spark: SparkSession, root: str, plan: TablePlan, planned: dict, settings: Settings
) -> DataFrame | None:
    if plan.looks_up:
        return None
    inputs = {
        name: planned[name] if name in planned else open_table(spark, root, name)
        for name in plan.inputs
    }
    # Names are not looked up where nothing is to run.
    return plan.build(spark, inputs, replace(settings, event_names=settings.event_names or ()))


def _plan_text(df: DataFrame | None) -> str:
    if df is None:
        return "built in several passes"
    return df._jdf.queryExecution().optimizedPlan().toString()
