"""The inputs of the feature store as tables bucketed alike by player.

They are made once from the stored layers and then follow the loads of single days; the feature store
comes from them without a shuffle, and without reading events again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playerlens.operators import features
from playerlens.plans.layers import open_table, stored_path
from playerlens.session import cut_lineage
from playerlens.settings import Settings
from playerlens.sinks.buckets import (
    bucket_count,
    details,
    replace_bucketed_days,
    write_bucketed,
)
from playerlens.sinks.tables import create_layers, table_path

PLAYER = features.PLAYER


def _users(users: DataFrame) -> DataFrame:
    needed = ("platform", "geo_country", "geo_continent", "install_date", "is_payer", "traffic_source")
    return users.select(PLAYER, *needed)


def _same(sessions: DataFrame) -> DataFrame:
    return sessions


#: By table: the stored table it comes from, how it is made, and the column of its day.
SOURCES: dict[str, tuple[str, Callable[[DataFrame], DataFrame], str | None]] = {
    "player_profiles": ("dim_users", _users, None),
    "player_sessions": ("fact_sessions", _same, "session_date"),
    "player_engagement": ("fact_events", features.engagement_days, "event_date"),
    "player_revenue": ("fact_revenue", features.revenue_days, "event_date"),
}


def table_name(prefix: str, name: str) -> str:
    return f"{prefix}_ml.{name}"


def build(
    spark: SparkSession, root: str, prefix: str = "game", buckets: int | None = None
) -> dict[str, str]:
    """Makes all four tables from the layers stored below ``root``; returns their names.

    Without ``buckets`` the largest of sessions and dimension decides their number.
    """
    create_layers(spark, prefix)
    n = buckets or bucket_count(
        spark, [stored_path(root, t) for t in ("fact_sessions", "dim_users")]
    )
    for name, (source, made, day) in SOURCES.items():
        rows = made(open_table(spark, root, source))
        if day is not None:
            rows = rows.select(*[c for c in rows.columns if c != day], day)
        write_bucketed(rows, table_name(prefix, name), table_path(root, "ml", name), PLAYER, n, day)
    return {name: table_name(prefix, name) for name in SOURCES}


def _on(day: str, days: Iterable[date]) -> Column:
    return F.col(day).isin([F.lit(d) for d in days])


def follow(
    spark: SparkSession,
    root: str,
    days: Iterable[date],
    session_days: Iterable[date] | None = None,
    prefix: str = "game",
) -> None:
    """Brings the tables up to date after the layers have followed a load of ``days``.

    ``session_days`` are those on which sessions have changed, if others than ``days``. Only these
    days are read and written; the profiles, one row a player, are made anew.
    """
    days = sorted(set(days))
    of_sessions = days if session_days is None else sorted(set(session_days))
    for name, (source, made, day) in SOURCES.items():
        stored = open_table(spark, root, source)
        full = table_name(prefix, name)
        if day is None:
            buckets = int(details(spark, full)["Num Buckets"])
            write_bucketed(made(stored), full, table_path(root, "ml", name), PLAYER, buckets)
            continue
        touched = of_sessions if day == "session_date" else days
        if touched:
            replace_bucketed_days(cut_lineage(made(stored.filter(_on(day, touched)))), full, touched)


def player_features(
    spark: SparkSession,
    settings: Settings = Settings(),
    computed_at: datetime | None = None,
    prefix: str = "game",
) -> DataFrame:
    """The feature store from the bucketed tables."""
    profiles, sessions, engagement, revenue = (
        spark.table(table_name(prefix, name)) for name in SOURCES
    )
    return features.feature_store_from_days(
        profiles,
        sessions,
        engagement,
        revenue,
        settings.ref_date,
        settings.lookback_days,
        settings.churn_after_days,
        computed_at,
    )
