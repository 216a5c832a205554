"""Read-outs on raw tables before and after loading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLAYER = "user_pseudo_id"


def source_summary(nested: DataFrame) -> DataFrame:
    day = F.to_date("event_date", "yyyyMMdd")
    return nested.agg(
        F.min(day).alias("earliest_date"),
        F.max(day).alias("latest_date"),
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct(PLAYER).alias("unique_users"),
    )


def event_name_counts(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_name")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.countDistinct(PLAYER).alias("unique_users"),
            F.round(F.avg("event_value_in_usd"), 4).alias("avg_value_usd"),
        )
        .orderBy(F.desc("event_count"), "event_name")
    )


def platform_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("platform").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct(PLAYER).alias("users")
    )


def top_countries(nested: DataFrame, n: int = 15) -> DataFrame:
    return (
        nested.groupBy(F.col("geo.country").alias("country"))
        .agg(F.count(F.lit(1)).alias("events"), F.countDistinct(PLAYER).alias("users"))
        .orderBy(F.desc("users"), "country")
        .limit(n)
    )


def top_param_keys(nested: DataFrame, n: int = 30) -> DataFrame:
    return (
        nested.select(F.explode("event_params.key").alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .orderBy(F.desc("occurrences"), "key")
        .limit(n)
    )


def raw_table_stats(raw: DataFrame, name: str = "raw_events") -> DataFrame:
    """Counts three distinct sets of a table that is first reduced to their combinations."""
    combos = raw.groupBy(PLAYER, "event_name", "event_date").agg(F.count(F.lit(1)).alias("n"))
    return combos.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.countDistinct(PLAYER).alias("unique_users"),
        F.countDistinct("event_name").alias("unique_events"),
        F.min("event_date").alias("earliest_date"),
        F.max("event_date").alias("latest_date"),
        F.countDistinct("event_date").alias("days_of_data"),
    )


def event_breakdown(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy("event_name")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.countDistinct(PLAYER).alias("unique_users"),
            F.round(F.sum(F.coalesce("event_value_in_usd", F.lit(0.0))), 2).alias(
                "total_value_usd"
            ),
            (F.avg("param_engagement_time_msec") / 1000).alias("avg_engagement_sec"),
        )
        .orderBy(F.desc("count"), "event_name")
    )


def install_summary(installs: DataFrame) -> DataFrame:
    return installs.agg(
        F.count(F.lit(1)).alias("total_installs"),
        F.countDistinct("appsflyer_id").alias("unique_devices"),
        F.min("install_time").alias("earliest"),
        F.max("install_time").alias("latest"),
    )


def revenue_by_event(events: DataFrame) -> DataFrame:
    """Revenue is added up in decimals: large totals are exact and the same on every run."""
    revenue = F.coalesce("event_revenue", F.lit(0.0)).cast("decimal(18,6)")
    return (
        events.groupBy("event_name")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.sum(revenue).cast("double").alias("total_revenue"),
        )
        .orderBy(F.desc("count"), "event_name")
    )


def installs_by_platform(installs: DataFrame) -> DataFrame:
    return installs.groupBy("platform").agg(F.count(F.lit(1)).alias("installs"))


def installs_by_media_source(installs: DataFrame) -> DataFrame:
    return (
        installs.groupBy("media_source")
        .agg(F.count(F.lit(1)).alias("installs"), F.avg("cost_value").alias("avg_cost"))
        .orderBy(F.desc("installs"), "media_source")
    )
