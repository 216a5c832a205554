"""Per-player feature store for segmentation and churn prediction."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerlens.functions.columns import ratio

PLAYER = "user_pseudo_id"

# Model columns, in the order the model sees them.
FEATURE_COLUMNS = (
    "sessions_total",
    "sessions_last_3d",
    "sessions_last_7d",
    "sessions_last_14d",
    "avg_session_duration",
    "std_session_duration",
    "max_session_duration",
    "total_play_time_sec",
    "avg_engagement_sec",
    "total_engagement_sec",
    "avg_events_per_session",
    "days_since_last_session",
    "active_days",
    "unique_event_types",
    "total_events",
    "max_level",
    "levels_started",
    "levels_completed",
    "levels_retried",
    "scores_posted",
    "best_score",
    "avg_score",
    "win_rate",
    "retry_rate",
    "event_trend_ratio",
    "avg_levels_per_session",
    "avg_retries_per_session",
    "avg_best_score_per_session",
    "total_spend",
    "iap_spend",
    "ad_revenue",
    "purchase_count",
    "avg_transaction_value",
    "days_since_last_purchase",
    "session_acceleration",
    "activity_rate",
    "level_velocity",
    "level_completion_rate",
    "account_age_days",
)
# Nearly determines the label, which is a rule on the same dates.
LEAKY_COLUMNS = ("days_since_last_session", "sessions_last_3d", "sessions_last_7d")


def _since(column: str, ref_date: date, days: int) -> Column:
    return F.col(column) >= F.date_sub(F.lit(ref_date), days)


def _session_aggregates(ref_date: date) -> list[Column]:
    def recent(days: int) -> Column:
        return F.count_if(_since("session_date", ref_date, days))

    length = F.col("session_duration_sec")
    return [
        F.count(F.lit(1)).alias("sessions_total"),
        recent(3).alias("sessions_last_3d"),
        recent(7).alias("sessions_last_7d"),
        recent(14).alias("sessions_last_14d"),
        F.avg(length).alias("avg_session_duration"),
        F.stddev_samp(length).alias("std_session_duration"),
        F.max(length).alias("max_session_duration"),
        F.sum(length).alias("total_play_time_sec"),
        F.avg("total_engagement_sec").alias("avg_engagement_sec"),
        F.sum("total_engagement_sec").alias("total_engagement_sec"),
        F.avg("events_count").alias("avg_events_per_session"),
        F.max("events_count").alias("max_events_per_session"),
        F.datediff(F.lit(ref_date), F.max("session_date")).alias("days_since_last_session"),
        F.countDistinct("session_date").alias("active_days"),
    ]


def _session_game_aggregates() -> list[Column]:
    return [
        F.avg("levels_completed").alias("avg_levels_per_session"),
        F.avg("levels_retried").alias("avg_retries_per_session"),
        F.max("max_level_in_session").alias("session_max_level"),
        F.avg("best_score").alias("avg_best_score_per_session"),
    ]


def activity_features(sessions: DataFrame, ref_date: date, lookback_days: int = 30) -> DataFrame:
    recent = sessions.filter(_since("session_date", ref_date, lookback_days))
    return recent.groupBy(PLAYER).agg(*_session_aggregates(ref_date))


def session_game_features(
    sessions: DataFrame, ref_date: date, lookback_days: int = 30
) -> DataFrame:
    recent = sessions.filter(_since("session_date", ref_date, lookback_days))
    return recent.groupBy(PLAYER).agg(*_session_game_aggregates())


def engagement_features(events: DataFrame, ref_date: date, lookback_days: int = 30) -> DataFrame:
    """The two windows of ``event_trend_ratio`` share the day ``ref_date - 3``."""
    name = F.col("event_name")

    def times(*names: str) -> Column:
        return F.count_if(name.isin(*names))

    ended, won = times("level_end"), F.count_if(
        (name == "level_end") & (F.col("param_success") == "true")
    )
    earlier = F.count_if(
        F.col("event_date").between(
            F.date_sub(F.lit(ref_date), 6), F.date_sub(F.lit(ref_date), 3)
        )
    )
    recent = events.filter(_since("event_date", ref_date, lookback_days))
    return recent.groupBy(PLAYER).agg(
        F.countDistinct("event_name").alias("unique_event_types"),
        F.count(F.lit(1)).alias("total_events"),
        F.max("param_level").alias("max_level"),
        times("level_start").alias("levels_started"),
        times("level_up").alias("levels_completed"),
        times("level_retry").alias("levels_retried"),
        times("post_score").alias("scores_posted"),
        F.max("param_score").alias("best_score"),
        F.avg(F.when(name == "post_score", F.col("param_score"))).alias("avg_score"),
        ratio(won, ended).alias("win_rate"),
        ratio(times("level_retry"), times("level_start", "level_retry")).alias("retry_rate"),
        (F.sum("engagement_time_msec").cast("double") / 1000.0).alias(
            "total_engagement_from_events"
        ),
        ratio(F.count_if(_since("event_date", ref_date, 3)), earlier).alias("event_trend_ratio"),
    )


def monetary_features(revenue: DataFrame, ref_date: date, lookback_days: int = 30) -> DataFrame:
    """``purchase_count`` counts every revenue row, also ads and those of zero value."""
    amount = F.col("revenue_amount")

    def spent_on(kind: str) -> Column:
        return F.sum(F.when(F.col("revenue_type") == kind, amount).otherwise(0.0))

    recent = revenue.filter(_since("event_date", ref_date, lookback_days))
    return recent.groupBy(PLAYER).agg(
        F.sum(amount).alias("total_spend"),
        spent_on("iap").alias("iap_spend"),
        spent_on("ad").alias("ad_revenue"),
        F.count(F.lit(1)).alias("purchase_count"),
        F.avg(amount).alias("avg_transaction_value"),
        F.max(amount).alias("max_transaction_value"),
        F.datediff(F.lit(ref_date), F.max("event_date")).alias("days_since_last_purchase"),
    )


def profile_features(users: DataFrame, ref_date: date) -> DataFrame:
    return users.select(
        PLAYER,
        "platform",
        "geo_country",
        "geo_continent",
        "install_date",
        F.datediff(F.lit(ref_date), "install_date").alias("account_age_days"),
        "is_payer",
        "traffic_source",
    )


def churn_labels(sessions: DataFrame, ref_date: date, churn_after_days: int = 7) -> DataFrame:
    """1 when the last session, over the full history, is older than the churn window."""
    stale = F.max("session_date") < F.date_sub(F.lit(ref_date), churn_after_days)
    return sessions.groupBy(PLAYER).agg(F.when(stale, 1).otherwise(0).alias("is_churned"))


# From days ----------------------------------------------------------------------------------


def engagement_days(events: DataFrame) -> DataFrame:
    """What a day adds to ``engagement_features``: one row per player, day and event name.

    Days can be made one by one. A player has few rows a day, however many events.
    """
    name = F.col("event_name")
    score = F.when(name == "post_score", F.col("param_score"))
    return events.groupBy(PLAYER, "event_date", "event_name").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("param_success") == "true").alias("successes"),
        F.max("param_level").alias("max_level"),
        F.max("param_score").alias("best_score"),
        F.sum(score).alias("score_sum"),
        F.count(score).alias("score_count"),
        F.sum("engagement_time_msec").alias("engagement_time_msec"),
    )


def revenue_days(revenue: DataFrame) -> DataFrame:
    """What a day adds to ``monetary_features``: one row per player, day and kind of revenue."""
    amount = F.col("revenue_amount")
    return revenue.groupBy(PLAYER, "event_date", "revenue_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(amount).alias("amounts"),
        F.sum(amount).alias("amount_sum"),
        F.max(amount).alias("max_amount"),
    )


def engagement_from_days(days: DataFrame, ref_date: date, lookback_days: int = 30) -> DataFrame:
    """``engagement_features`` from ``engagement_days``."""
    name, events = F.col("event_name"), F.col("events")

    def total(value: Column, rows: Column) -> Column:
        return F.sum(F.when(rows, value).otherwise(F.lit(0)))

    def times(*names: str) -> Column:
        return total(events, name.isin(*names))

    earlier = F.col("event_date").between(
        F.date_sub(F.lit(ref_date), 6), F.date_sub(F.lit(ref_date), 3)
    )
    recent = days.filter(_since("event_date", ref_date, lookback_days))
    return recent.groupBy(PLAYER).agg(
        F.countDistinct("event_name").alias("unique_event_types"),
        F.sum(events).alias("total_events"),
        F.max("max_level").alias("max_level"),
        times("level_start").alias("levels_started"),
        times("level_up").alias("levels_completed"),
        times("level_retry").alias("levels_retried"),
        times("post_score").alias("scores_posted"),
        F.max("best_score").alias("best_score"),
        ratio(F.sum("score_sum"), F.sum("score_count")).alias("avg_score"),
        ratio(total(F.col("successes"), name == "level_end"), times("level_end")).alias("win_rate"),
        ratio(times("level_retry"), times("level_start", "level_retry")).alias("retry_rate"),
        (F.sum("engagement_time_msec").cast("double") / 1000.0).alias(
            "total_engagement_from_events"
        ),
        ratio(total(events, _since("event_date", ref_date, 3)), total(events, earlier)).alias(
            "event_trend_ratio"
        ),
    )


def monetary_from_days(days: DataFrame, ref_date: date, lookback_days: int = 30) -> DataFrame:
    """``monetary_features`` from ``revenue_days``; sums of doubles may differ in their last digits."""
    amount = F.col("amount_sum")

    def spent_on(kind: str) -> Column:
        return F.sum(F.when(F.col("revenue_type") == kind, amount).otherwise(0.0))

    recent = days.filter(_since("event_date", ref_date, lookback_days))
    return recent.groupBy(PLAYER).agg(
        F.sum(amount).alias("total_spend"),
        spent_on("iap").alias("iap_spend"),
        spent_on("ad").alias("ad_revenue"),
        F.sum("rows").alias("purchase_count"),
        ratio(F.sum(amount), F.sum("amounts")).alias("avg_transaction_value"),
        F.max("max_amount").alias("max_transaction_value"),
        F.datediff(F.lit(ref_date), F.max("event_date")).alias("days_since_last_purchase"),
    )


# Feature store ------------------------------------------------------------------------------


def feature_store(
    users: DataFrame,
    sessions: DataFrame,
    events: DataFrame,
    revenue: DataFrame,
    ref_date: date,
    lookback_days: int = 30,
    churn_after_days: int = 7,
    computed_at: datetime | None = None,
) -> DataFrame:
    """One row per player dimension row.

    Every input is aggregated by player, so the joins reuse one hash partitioning. The date
    filters are on literals and reach the scans. ``computed_at`` defaults to now.
    """
    engaged = engagement_features(events, ref_date, lookback_days)
    spent = monetary_features(revenue, ref_date, lookback_days)
    return _store(
        users, sessions, engaged, spent, ref_date, lookback_days, churn_after_days, computed_at
    )


def feature_store_from_days(
    users: DataFrame,
    sessions: DataFrame,
    engagement: DataFrame,
    revenue: DataFrame,
    ref_date: date,
    lookback_days: int = 30,
    churn_after_days: int = 7,
    computed_at: datetime | None = None,
) -> DataFrame:
    """``feature_store`` from ``engagement_days`` and ``revenue_days`` instead of the facts.

    From four tables bucketed alike by player no row is shuffled.
    """
    engaged = engagement_from_days(engagement, ref_date, lookback_days)
    spent = monetary_from_days(revenue, ref_date, lookback_days)
    return _store(
        users, sessions, engaged, spent, ref_date, lookback_days, churn_after_days, computed_at
    )


def _store(
    users: DataFrame,
    sessions: DataFrame,
    engaged: DataFrame,
    spent: DataFrame,
    ref_date: date,
    lookback_days: int,
    churn_after_days: int,
    computed_at: datetime | None,
) -> DataFrame:
    recent = sessions.filter(_since("session_date", ref_date, lookback_days))
    played = recent.groupBy(PLAYER).agg(*_session_aggregates(ref_date), *_session_game_aggregates())
    joined = (
        profile_features(users, ref_date)
        .join(played, PLAYER, "left")
        .join(engaged, PLAYER, "left")
        .join(spent, PLAYER, "left")
        .join(churn_labels(sessions, ref_date, churn_after_days), PLAYER, "left")
    )

    def or_zero(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).alias(column)

    def or_lookback(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(lookback_days)).alias(column)

    late = ("days_since_last_session", "days_since_last_purchase")
    ratios = ("session_acceleration", "activity_rate", "level_velocity", "level_completion_rate")
    filled = [
        or_lookback(c) if c in late else or_zero(c)
        for c in FEATURE_COLUMNS
        if c not in ratios and c != "account_age_days"
    ]
    stamp = F.lit(computed_at) if computed_at is not None else F.current_timestamp()
    age = F.col("account_age_days")
    return joined.select(
        PLAYER,
        "platform",
        "geo_country",
        "geo_continent",
        "account_age_days",
        "is_payer",
        "traffic_source",
        *filled,
        ratio(F.col("sessions_last_3d"), F.col("sessions_last_7d")).alias("session_acceleration"),
        ratio(F.col("active_days"), age).alias("activity_rate"),
        ratio(F.col("levels_completed"), age).alias("level_velocity"),
        ratio(F.col("levels_completed"), F.col("levels_started")).alias("level_completion_rate"),
        F.coalesce("is_churned", F.lit(1)).alias("is_churned"),
        stamp.cast("timestamp").alias("feature_computed_at"),
    )


def latest_snapshot(df: DataFrame, stamp: str = "feature_computed_at") -> DataFrame:
    """Rows of the newest computation; the maximum is a scalar subquery on one column."""
    return df.filter(F.col(stamp) == df.agg(F.max(stamp)).scalar())
