"""Brings the stored tables up to date after some days of raw events have come, late or again.

What a day's load can change is followed from table to table:

- events, and the facts made of single events, of these days;
- sessions of the players who had or have events on these days, from the last session that began
  before the change (it may reach over midnight into it); their later sessions too, whose numbers may
  move. Only days in which a session has really changed are rewritten;
- the user dimension: these players' rows;
- activity bitmaps: the spans of these days;
- marts by day: these days, those in whose trailing window they lie, the days with changed sessions,
  and the days whose installs have changed.

Marts over all players are made anew from the dimension and the bitmaps; the level funnel reads all
level events. The result is that of a full run, but that the segments and predictions of a churn run
stay in the user dimension.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playerlens.operators import activity, marts, sketches, staging, warehouse
from playerlens.plans import player_tables
from playerlens.plans.layers import BY_NAME, open_table, run_layers, stored_path
from playerlens.session import cut_lineage
from playerlens.settings import Settings
from playerlens.sinks.tables import replace_partitions, rewrite_table

PLAYER = "user_pseudo_id"
#: Columns of the user dimension that a churn run fills in.
PREDICTED = ("player_segment", "churn_probability", "ltv_predicted")
#: Made anew from other tables, in this order.
WHOLE = ("mart_player_segments", "mart_level_funnel", "mart_geo_stats", "mart_level_funnel_enriched")


def _on(df: DataFrame, column: str, days: Iterable[date]) -> DataFrame:
    return df.filter(F.col(column).isin(sorted(days)))


def _dates(df: DataFrame, column: str) -> set[date]:
    """Distinct days; as many as a calendar has."""
    return {r[0] for r in df.select(column).distinct().collect() if r[0] is not None}


@dataclass
class Update:
    """One update of the tables below ``root``; ``rows`` counts what was written, by table."""

    spark: SparkSession
    root: str
    days: list[date]
    settings: Settings

    def __post_init__(self):
        self.rows: dict[str, int] = {}

    def table(self, name: str) -> DataFrame:
        return open_table(self.spark, self.root, name)

    def replace(self, name: str, df: DataFrame, days: Iterable[date]) -> None:
        """Puts ``df`` in the place of these days of a table that is stored by day."""
        plan = BY_NAME[name]
        path = stored_path(self.root, name)
        columns = self.table(name).columns
        self.rows[name] = replace_partitions(
            self.spark, df.select(*columns), path, plan.partition, sorted(days), plan.cluster
        )

    def replace_days(self, name: str, new: DataFrame, days: Iterable[date]) -> None:
        """The same for a mart, which has a row or few a day and is stored as a whole."""
        stored = self.table(name)
        new = cut_lineage(new.select(*stored.columns))
        kept = stored.filter(~F.coalesce(F.col("date").isin(sorted(days)), F.lit(False)))
        rewrite_table(kept.unionByName(new), stored_path(self.root, name))
        self.rows[name] = new.count()

    def events(self) -> DataFrame:
        """Rewrites the days' events; returns the players they had or have, and since when."""
        old = _on(self.table("stg_events"), "event_date", self.days).select(PLAYER, "event_timestamp")
        raw = _on(self.table("raw_events"), "event_date", self.days)
        new = cut_lineage(staging.stg_events(raw))
        both = old.unionByName(new.select(PLAYER, "event_timestamp"))
        touched = cut_lineage(both.groupBy(PLAYER).agg(F.min("event_timestamp").alias("since")))
        self.replace("stg_events", new, self.days)
        return touched

    def facts(self) -> None:
        events = _on(self.table("stg_events"), "event_date", self.days)
        for name, build in (
            ("fact_events", warehouse.fact_events),
            ("fact_revenue", warehouse.fact_revenue),
            ("fact_levels", warehouse.fact_levels),
        ):
            self.replace(name, build(events), self.days)

    def sessions(self, touched: DataFrame) -> set[date]:
        """Rewrites the days with changed sessions and returns them."""
        stored = self.table("stg_sessions")
        mine = stored.join(touched, PLAYER)
        earlier = F.col("session_start") <= F.col("since")
        last = (
            mine.filter(earlier)
            .groupBy(PLAYER)
            .agg(
                F.max("session_start").alias("restart"),
                (F.count(F.lit(1)) - 1).alias("sessions"),
                F.max_by("session_date", "session_start").alias("restart_date"),
            )
        )
        # A player without an earlier session has no event before the change.
        restarts = cut_lineage(
            touched.join(last, PLAYER, "left").select(
                PLAYER,
                F.coalesce("restart", "since").alias("restart"),
                F.coalesce("sessions", F.lit(0)).cast("bigint").alias("sessions"),
                "restart_date",
            )
        )
        since = min([*_dates(restarts.agg(F.min("restart_date").alias("d")), "d"), *self.days])
        again = (
            self.table("stg_events")
            .filter(F.col("event_date") >= F.lit(since))
            .join(restarts.select(PLAYER, "restart"), PLAYER)
            .filter(F.col("event_timestamp") >= F.col("restart"))
            .drop("restart")
        )
        again = cut_lineage(again)
        new = cut_lineage(
            staging.stg_sessions(
                again,
                self.settings.session_gap_minutes,
                self.settings.event_names,
                before=restarts.select(PLAYER, "sessions"),
            )
        )
        anew = F.col("session_start") >= F.col("restart")
        redone = stored.join(restarts.select(PLAYER, "restart"), PLAYER, "left")
        old = redone.filter(anew).select(*new.columns)
        changed = old.exceptAll(new).unionByName(new.exceptAll(old))
        days = _dates(changed, "session_date")
        if days:
            kept = _on(redone, "session_date", days).filter(~F.coalesce(anew, F.lit(False)))
            rows = cut_lineage(kept.select(*new.columns).unionByName(_on(new, "session_date", days)))
            self.replace("stg_sessions", rows, days)
            self.replace("fact_sessions", warehouse.fact_sessions(rows), days)
        return days

    def users(self, touched: DataFrame) -> set[date]:
        """Makes the players' rows anew; returns the days whose installs have changed."""
        stored = self.table("dim_users")
        players = touched.select(PLAYER)
        events = self.table("stg_events").join(players, PLAYER, "left_semi")
        before = stored.join(players, PLAYER, "left_semi")
        fresh = warehouse.dim_users(events, self.settings.ref_date).drop(*PREDICTED)
        filled = [c for c in stored.columns if c not in fresh.columns]
        predicted = before.select(PLAYER, "user_id", *filled)
        new = cut_lineage(fresh.join(predicted, [PLAYER, "user_id"], "left").select(*stored.columns))
        install = (PLAYER, "user_id", "platform", "install_date")
        was, now = before.select(*install), new.select(*install)
        installed = _dates(was.exceptAll(now).unionByName(now.exceptAll(was)), "install_date")
        others = stored.join(players, PLAYER, "left_anti").withColumn(
            "days_since_last_active", F.datediff(F.lit(self.settings.ref_date), "last_active_date")
        )
        rewrite_table(others.unionByName(new), stored_path(self.root, "dim_users"))
        self.rows["dim_users"] = new.count()
        return installed

    def bitmaps(self) -> None:
        events = _on(self.table("stg_events"), "event_date", self.days)
        path = stored_path(self.root, "player_activity")
        self.rows["player_activity"] = activity.replace_activity(self.spark, path, self.days, events)

    def marts_by_day(self, session_days: set[date], installed: set[date]) -> None:
        window = self.settings.active_window_days
        trailing = {d + timedelta(days=n) for d in self.days for n in range(window)}
        dates = trailing | session_days | installed
        events, sessions = self.table("fact_events"), self.table("fact_sessions")
        near = {d - timedelta(days=n) for d in dates for n in range(window)}
        kpis = marts.mart_daily_kpis(
            _on(events, "event_date", near),
            _on(sessions, "session_date", dates),
            _on(self.table("dim_users"), "install_date", dates),
            window,
        )
        self.replace_days("mart_daily_kpis", _on(kpis, "date", dates), dates)
        revenue = _on(self.table("fact_revenue"), "event_date", self.days)
        self.replace_days("mart_revenue_daily", marts.mart_revenue_daily(revenue), self.days)
        active = sketches.day_activity(_on(events, "event_date", self.days))
        self.replace_days("day_activity", active, self.days)
        scores = sketches.day_scores(_on(self.table("fact_levels"), "event_date", self.days))
        self.replace_days("day_scores", scores, self.days)
        if session_days:
            of_days = _on(sessions, "session_date", session_days)
            self.replace_days("mart_session_stats", marts.mart_session_stats(of_days), session_days)
            self.replace_days("day_sessions", sketches.day_sessions(of_days), session_days)

    def cohorts(self) -> None:
        made = activity.retention_cohorts(self.table("dim_users"), self.table("player_activity"))
        self.rows["mart_retention_cohorts"] = rewrite_table(
            made, stored_path(self.root, "mart_retention_cohorts")
        )


def update_layers(
    spark: SparkSession,
    root: str,
    days: Sequence[date],
    settings: Settings = Settings(),
    bucketed: str | None = None,
) -> dict[str, dict]:
    """Updates the tables below ``root``, which a full run has stored, for loads of ``days``.

    With ``bucketed``, a prefix, the tables of ``player_tables.build`` follow as well.

    The raw events have to be loaded already; copies of one event have one ``event_date``. A failure
    ends the update; running it again with the same days mends what it left, but for events that were
    in the tables before the first try and are in no raw row any more.
    """
    started = time.monotonic()
    now = Update(spark, root, sorted(set(days)), settings)
    if not now.days:
        return {}
    touched = now.events()
    now.facts()
    session_days = now.sessions(touched)
    installed = now.users(touched)
    now.bitmaps()
    now.marts_by_day(session_days, installed)
    now.cohorts()
    if bucketed:
        player_tables.follow(spark, root, now.days, session_days, bucketed)
    report = {n: {"status": "success", "rows": r} for n, r in now.rows.items()}
    report |= run_layers(spark, root, settings=settings, only=WHOLE)
    report["seconds"] = {"status": "success", "rows": round(time.monotonic() - started)}
    return report
