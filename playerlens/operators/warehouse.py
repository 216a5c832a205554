"""Star schema: calendar, players, and the event, session, revenue and level facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playerlens.functions.columns import sunday_week, week_label
from playerlens.settings import AD_EVENTS, LEVEL_EVENTS, PURCHASE_EVENTS, REVENUE_EVENTS

PLAYER = "user_pseudo_id"
FIRST_TOUCH = (
    "platform",
    "device_category",
    "device_brand",
    "device_os",
    "geo_country",
    "geo_continent",
    "traffic_source",
    "traffic_medium",
    "traffic_campaign",
)


def dim_dates(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    return calendar(spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last")))


def calendar(span: DataFrame) -> DataFrame:
    """The calendar of a one-row frame with the days ``first`` and ``last``."""
    span = span.select(F.explode(F.sequence("first", "last")).alias("date_key"))
    day = F.col("date_key")
    return span.select(
        "date_key",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        sunday_week(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        week_label(day).alias("year_week"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def first_seen(events: DataFrame) -> DataFrame:
    """First day and time of each (player, account)."""
    return events.groupBy(PLAYER, "user_id").agg(
        F.min("event_date").alias("first_seen_date"),
        F.min("event_timestamp").alias("first_seen_timestamp"),
        F.min("user_first_touch_timestamp").alias("first_touch_timestamp"),
    )


def lifetime_activity(events: DataFrame) -> DataFrame:
    """Totals per player, in hash aggregates only."""
    bought = F.col("event_name").isin(*PURCHASE_EVENTS) & (F.col("event_value_usd") > 0)
    return events.groupBy(PLAYER).agg(
        F.max("event_date").alias("last_active_date"),
        F.countDistinct("event_date").alias("active_days"),
        F.sum("event_value_usd").alias("total_revenue"),
        F.count_if(bought).alias("purchase_count"),
        F.max("param_level").alias("max_level"),
        (F.sum("engagement_time_msec").cast("double") / 1000.0 / 60.0).alias(
            "total_engagement_minutes"
        ),
        F.count(F.lit(1)).alias("total_events"),
    )


def first_touch(events: DataFrame, columns=FIRST_TOUCH) -> DataFrame:
    """Attributes of each player's first event, NULLs included.

    One aggregate instead of a window per attribute: it combines before the shuffle.
    """
    touch = F.min_by(F.struct(*columns), F.struct("event_timestamp", "event_id"))
    return events.groupBy(PLAYER).agg(touch.alias("touch")).select(PLAYER, "touch.*")


def _account_days(events: DataFrame) -> DataFrame:
    """What the user dimension needs, reduced to one row per (player, account, day)."""
    bought = F.col("event_name").isin(*PURCHASE_EVENTS) & (F.col("event_value_usd") > 0)
    return events.groupBy(PLAYER, "user_id", "event_date").agg(
        F.min("event_timestamp").alias("first_timestamp"),
        F.min("user_first_touch_timestamp").alias("first_touch_timestamp"),
        F.sum("event_value_usd").alias("revenue"),
        F.count_if(bought).alias("purchases"),
        F.max("param_level").alias("max_level"),
        F.sum("engagement_time_msec").alias("engagement_msec"),
        F.count(F.lit(1)).alias("events"),
    )


def dim_users(events: DataFrame, ref_date: date, one_row_per_player: bool = False) -> DataFrame:
    """One row per (player, account); lifetime values and first-touch attributes per player.

    ``one_row_per_player`` keeps the earliest account only, so totals are not repeated.
    """
    of_player = Window.partitionBy(PLAYER)
    minutes = F.sum("engagement_msec").over(of_player).cast("double") / 1000.0 / 60.0
    totals = {
        "last_active_date": F.max("event_date").over(of_player),
        "active_days": F.size(F.collect_set("event_date").over(of_player)).cast("bigint"),
        "total_revenue": F.sum("revenue").over(of_player),
        "purchase_count": F.sum("purchases").over(of_player),
        "max_level": F.max("max_level").over(of_player),
        "total_engagement_minutes": minutes,
        "total_events": F.sum("events").over(of_player),
    }
    days = _account_days(events).select(
        PLAYER,
        "user_id",
        "event_date",
        "first_timestamp",
        "first_touch_timestamp",
        *[c.alias(name) for name, c in totals.items()],
    )
    seen = days.groupBy(PLAYER, "user_id").agg(
        F.min("event_date").alias("first_seen_date"),
        F.min("first_timestamp").alias("first_seen_timestamp"),
        F.min("first_touch_timestamp").alias("first_touch_timestamp"),
        *[F.max(name).alias(name) for name in totals],
    )
    if one_row_per_player:
        earliest = F.min(
            F.struct(
                "first_seen_timestamp",
                "user_id",
                "first_seen_date",
                "first_touch_timestamp",
                *totals,
            )
        )
        seen = seen.groupBy(PLAYER).agg(earliest.alias("s")).select(PLAYER, "s.*")
    # Events are read twice: once in hash aggregates down to account-days, of which a player has few
    # rows, and once for the first touch, whose texts need a sorting aggregate.
    return (
        seen.join(first_touch(events), PLAYER, "left")
        .select(
            PLAYER,
            "user_id",
            F.col("first_seen_date").alias("install_date"),
            "first_touch_timestamp",
            *FIRST_TOUCH,
            "last_active_date",
            "active_days",
            "total_revenue",
            "purchase_count",
            "max_level",
            "total_engagement_minutes",
            "total_events",
            F.datediff("last_active_date", "first_seen_date").alias("lifetime_days"),
            F.datediff(F.lit(ref_date), "last_active_date").alias("days_since_last_active"),
            (F.col("total_revenue") > 0).alias("is_payer"),
            F.lit(None).cast("string").alias("player_segment"),
            F.lit(None).cast("double").alias("churn_probability"),
            F.lit(None).cast("double").alias("ltv_predicted"),
        )
    )


def fact_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        PLAYER,
        "user_id",
        "event_date",
        "event_timestamp",
        "event_name",
        "event_value_usd",
        "platform",
        "geo_country",
        "geo_continent",
        "traffic_source",
        "traffic_medium",
        "param_level",
        "param_score",
        "param_board",
        "param_success",
        "engagement_time_msec",
    )


def fact_sessions(sessions: DataFrame) -> DataFrame:
    return sessions


def fact_revenue(events: DataFrame) -> DataFrame:
    name = F.col("event_name")
    kind = (
        F.when(name == "in_app_purchase", "iap")
        .when(name.isin(*AD_EVENTS), "ad")
        .when(name == "earn_virtual_currency", "virtual")
        .otherwise("other")
    )
    return events.filter((F.col("event_value_usd") > 0) | name.isin(*REVENUE_EVENTS)).select(
        "event_id",
        PLAYER,
        "user_id",
        "event_date",
        "event_timestamp",
        "event_name",
        F.col("event_value_usd").alias("revenue_amount"),
        kind.alias("revenue_type"),
        "platform",
        "geo_country",
        "traffic_source",
        "param_virtual_currency_name",
    )


def fact_levels(events: DataFrame) -> DataFrame:
    name, success = F.col("event_name"), F.col("param_success")
    action = (
        F.when(name == "level_start", "started")
        .when(name == "level_up", "completed")
        .when((name == "level_end") & (success == "true"), "won")
        .when((name == "level_end") & (success == "false"), "lost")
        .when(name == "level_retry", "retried")
        .when(name == "level_reset", "reset")
        .otherwise(name)
    )
    return events.filter(name.isin(*LEVEL_EVENTS)).select(
        "event_id",
        PLAYER,
        "user_id",
        "event_date",
        "event_timestamp",
        "event_name",
        F.col("param_level").alias("level_number"),
        F.col("param_score").alias("score"),
        F.col("param_board").alias("board"),
        success.alias("success"),
        "platform",
        "geo_country",
        action.alias("level_action"),
    )
