"""Dashboard queries over the marts, facts and model tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playerlens.functions.columns import ratio, week_label
from playerlens.operators.ranking import observed_quantiles

PLAYER = "user_pseudo_id"


def dau_mau_trend(kpis: DataFrame, date_from: date, date_to: date) -> DataFrame:
    return (
        kpis.filter(F.col("date").between(F.lit(date_from), F.lit(date_to)))
        .select(
            "date",
            "platform",
            "dau",
            "mau",
            "stickiness",
            "new_users",
            "total_events",
            "total_sessions",
            "sessions_per_dau",
            "avg_session_duration_sec",
            "avg_engagement_sec",
            "avg_levels_per_session",
        )
        .orderBy("date")
    )


def retention_heatmap(cohorts: DataFrame, date_from: date, date_to: date) -> DataFrame:
    return (
        cohorts.filter(F.col("cohort_date").between(F.lit(date_from), F.lit(date_to)))
        .select(
            "cohort_date",
            "platform",
            "traffic_source",
            "cohort_size",
            "d1_retention",
            "d3_retention",
            "d7_retention",
            "d14_retention",
            "d30_retention",
        )
        .orderBy(F.desc("cohort_date"))
    )


def session_trend(stats: DataFrame, date_from: date, date_to: date) -> DataFrame:
    return (
        stats.filter(F.col("date").between(F.lit(date_from), F.lit(date_to)))
        .select(
            "date",
            "platform",
            "total_sessions",
            "unique_users",
            "avg_duration_sec",
            "median_duration_sec",
            "avg_engagement_sec",
            "avg_levels_per_session",
            "sessions_under_1min",
            "sessions_1_5min",
            "sessions_5_15min",
            "sessions_over_15min",
        )
        .orderBy("date")
    )


def level_progression(funnel: DataFrame, max_level: int = 100) -> DataFrame:
    return funnel.filter(F.col("level_number") <= max_level).orderBy("level_number")


def country_breakdown(geo: DataFrame) -> DataFrame:
    return geo.orderBy(F.desc("total_users"), "geo_country")


def revenue_trend(revenue_daily: DataFrame, date_from: date, date_to: date) -> DataFrame:
    return revenue_daily.filter(F.col("date").between(F.lit(date_from), F.lit(date_to))).orderBy(
        "date"
    )


def arpu_trend(kpis: DataFrame, date_from: date, date_to: date) -> DataFrame:
    return (
        kpis.filter(F.col("date").between(F.lit(date_from), F.lit(date_to)))
        .select(
            "date",
            "platform",
            "arpu",
            "arppu",
            "dau",
            "paying_users",
            "total_revenue",
            "payer_conversion_rate",
        )
        .orderBy("date")
    )


def segment_distribution(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("player_segment")
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.sum("total_revenue").alias("segment_revenue"),
            F.avg("total_revenue").alias("avg_revenue"),
            F.avg("active_days").alias("avg_active_days"),
            F.avg("max_level").alias("avg_level"),
            F.avg("total_engagement_minutes").alias("avg_engagement_min"),
        )
        .orderBy(F.desc("segment_revenue"))
    )


def ltv_curves(
    users: DataFrame, revenue: DataFrame, max_day: int = 30, cumulative: bool = False
) -> DataFrame:
    """Revenue per (cohort week, day since install).

    ``cumulative_revenue`` is that day's revenue under the name the dashboards use;
    ``cumulative=True`` makes it the running total of the cohort.
    """
    paid = revenue.select(PLAYER, "event_date", "revenue_amount")
    cohorts = users.select(PLAYER, "install_date")
    age = F.datediff("event_date", "install_date")
    # Summed per player-day first: one row per player and day goes into the join and the distinct.
    daily = paid.groupBy(PLAYER, "event_date").agg(F.sum("revenue_amount").alias("amount"))
    curve = (
        cohorts.join(daily, PLAYER)
        .withColumn("days_since_install", age)
        .filter(F.col("days_since_install").between(0, max_day))
        .groupBy(week_label(F.col("install_date")).alias("cohort_week"), "days_since_install")
        .agg(
            F.countDistinct(PLAYER).alias("paying_users"),
            F.sum("amount").alias("cumulative_revenue"),
        )
    )
    if cumulative:
        so_far = Window.partitionBy("cohort_week").orderBy("days_since_install")
        curve = curve.withColumn("cumulative_revenue", F.sum("cumulative_revenue").over(so_far))
    return curve.orderBy("cohort_week", "days_since_install")


def level_actions(levels: DataFrame) -> DataFrame:
    return (
        levels.filter(F.col("level_number").isNotNull())
        .groupBy("level_number", "level_action")
        .agg(
            F.count(F.lit(1)).alias("action_count"),
            F.countDistinct(PLAYER).alias("unique_users"),
            F.avg("score").alias("avg_score"),
        )
        .orderBy("level_number", "level_action")
    )


def win_rates(levels: DataFrame) -> DataFrame:
    action = F.col("level_action")
    return (
        levels.filter(F.col("level_number").isNotNull())
        .groupBy("level_number")
        .agg(
            F.count_if(action == "won").alias("wins"),
            F.count_if(action == "lost").alias("losses"),
            F.count_if(action == "retried").alias("retries"),
            ratio(F.count_if(action == "won"), F.count_if(action.isin("won", "lost"))).alias(
                "win_rate"
            ),
        )
        .orderBy("level_number")
    )


def score_distribution(levels: DataFrame) -> DataFrame:
    """Score quartiles per level; observed scores, not interpolated ones."""
    scores = levels.filter(
        (F.col("event_name") == "post_score")
        & F.col("score").isNotNull()
        & F.col("level_number").isNotNull()
    )
    quartiles = observed_quantiles(
        scores.groupBy("level_number", "score").agg(F.count(F.lit(1)).alias("_n")),
        ["level_number"],
        "score",
        "_n",
        {"q25_score": 0.25, "median_score": 0.5, "q75_score": 0.75},
    )
    plain = scores.groupBy("level_number").agg(
        F.countDistinct(PLAYER).alias("players"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.avg("score").alias("avg_score"),
    )
    return (
        plain.join(quartiles, "level_number")
        .select(
            "level_number",
            "players",
            "min_score",
            "q25_score",
            "median_score",
            "q75_score",
            "max_score",
            "avg_score",
        )
        .orderBy("level_number")
    )


def traffic_performance(users: DataFrame, recent_days: int = 7) -> DataFrame:
    """Per traffic source. ``retention_rate`` is the share active in the last ``recent_days``."""
    source = ["traffic_source", "traffic_medium"]
    averaged = ("active_days", "max_level", "total_engagement_minutes", "lifetime_days")
    per_player = users.groupBy(*source, PLAYER).agg(
        F.max(F.col("days_since_last_active") <= recent_days).alias("recent"),
        F.sum("total_revenue").alias("total_revenue"),
        *[F.sum(c).alias(f"sum_{c}") for c in averaged],
        *[F.count(c).alias(f"n_{c}") for c in averaged],
    )

    def mean(column: str):
        return ratio(F.sum(f"sum_{column}"), F.sum(f"n_{column}"))

    return (
        per_player.groupBy(*source)
        .agg(
            F.count(PLAYER).alias("users"),
            mean("active_days").alias("avg_active_days"),
            mean("max_level").alias("avg_level"),
            mean("total_engagement_minutes").alias("avg_engagement_min"),
            F.sum("total_revenue").alias("total_revenue"),
            mean("lifetime_days").alias("avg_lifetime_days"),
            ratio(F.count_if("recent"), F.count(PLAYER)).alias("retention_rate"),
        )
        .orderBy(F.desc("users"), *source)
    )


def churn_risk_distribution(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("risk_tier", "predicted_churn")
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.avg("churn_probability").alias("avg_probability"),
        )
        .orderBy(F.desc("avg_probability"))
    )


def churn_risk_by_segment(predictions: DataFrame, segments: DataFrame) -> DataFrame:
    return (
        predictions.select(PLAYER, "risk_tier", "churn_probability")
        .join(segments.select(PLAYER, "player_segment"), PLAYER)
        .groupBy("player_segment", "risk_tier")
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.avg("churn_probability").alias("avg_churn_prob"),
        )
        .orderBy("player_segment", F.desc("avg_churn_prob"))
    )


def model_history(metadata: DataFrame) -> DataFrame:
    return metadata.select(
        "model_version", "trained_at", "auc_roc", "f1_score", "precision", "recall"
    ).orderBy(F.desc("trained_at"))
