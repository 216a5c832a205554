"""Aggregated tables behind the dashboards.

Distinct counts are taken in two steps (per player, then per group), so no step holds all rows
of a group in one task and no plan multiplies its input for several distinct sets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playerlens.functions.columns import ratio
from playerlens.operators.ranking import Ordering, ntiles, observed_quantiles
from playerlens.settings import COMPLETION_EVENTS, RETENTION_DAYS

PLAYER = "user_pseudo_id"


def _player_days(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date", "platform", PLAYER).agg(
        F.max(F.col("event_value_usd") > 0).alias("paid"),
        F.sum("event_value_usd").alias("revenue"),
        F.count(F.lit(1)).alias("events"),
        F.sum("engagement_time_msec").alias("engagement_msec"),
    )


def daily_active(events: DataFrame) -> DataFrame:
    return (
        _player_days(events)
        .groupBy(F.col("event_date").alias("date"), "platform")
        .agg(
            F.count(PLAYER).alias("dau"),
            F.count_if("paid").alias("paying_users"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("events").alias("total_events"),
            (F.sum("engagement_msec").cast("double") / 1000.0).alias("total_engagement_sec"),
        )
    )


def rolling_active(events: DataFrame, days: int = 30) -> DataFrame:
    """Distinct players of the trailing ``days`` for each (date, platform) with activity.

    A player active on day d counts from d to d + days - 1. Cutting each such span where the
    player's previous one still runs leaves spans that do not overlap, so a running sum of
    "enters" and "leaves" per date is the distinct count: two small rows per player-day, and
    neither a range join nor a distinct over ``days`` copies.
    """
    active = events.filter(F.col("platform").isNotNull() & F.col("event_date").isNotNull())
    previous = F.lag("event_date").over(
        Window.partitionBy(PLAYER, "platform").orderBy("event_date")
    )
    spans = (
        active.select(PLAYER, "platform", "event_date")
        .distinct()
        .select("platform", "event_date", previous.alias("previous"))
    )
    enters = F.greatest("event_date", F.date_add("previous", days))
    leaves = F.date_add("event_date", days)

    def step(day: Column, change: int, seen: bool = False) -> Column:
        return F.struct(day.alias("date"), F.lit(change).alias("change"), F.lit(seen).alias("seen"))

    # The first one changes nothing; it marks a date with activity.
    changes = F.array(step(F.col("event_date"), 0, True), step(enters, 1), step(leaves, -1))
    steps = spans.select("platform", F.inline(changes))
    per_date = steps.groupBy("date", "platform").agg(
        F.sum("change").alias("change"), F.max("seen").alias("seen")
    )
    so_far = Window.partitionBy("platform").orderBy("date")
    return (
        per_date.withColumn("mau", F.sum("change").over(so_far))
        .filter("seen")
        .select("date", "platform", "mau")
    )


def _daily_and_rolling(events: DataFrame, days: int) -> DataFrame:
    """``daily_active`` with ``mau`` of ``rolling_active``, from one pass over the events.

    The step that marks a date with activity carries the player-day's figures.
    """
    previous = F.lag("event_date").over(
        Window.partitionBy(PLAYER, "platform").orderBy("event_date")
    )
    figures = {"paid": "boolean", "revenue": "double", "events": "bigint"}

    def step(day: Column, change: int, seen: bool = False) -> Column:
        own = [
            (F.col(c) if seen else F.lit(None)).cast(kind).alias(c) for c, kind in figures.items()
        ]
        return F.struct(
            day.alias("date"), F.lit(change).alias("change"), F.lit(seen).alias("seen"), *own
        )

    enters = F.greatest("event_date", F.date_add(previous, days))
    leaves = F.date_add("event_date", days)
    changes = F.array(step(F.col("event_date"), 0, True), step(enters, 1), step(leaves, -1))
    steps = _player_days(events).select("platform", changes.alias("steps"))
    per_date = (
        steps.select("platform", F.inline("steps"))
        .groupBy("date", "platform")
        .agg(
            F.sum("change").alias("change"),
            F.count_if("seen").alias("dau"),
            F.count_if("paid").alias("paying_users"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("events").alias("total_events"),
        )
    )
    so_far = Window.partitionBy("platform").orderBy("date")
    known = F.col("platform").isNotNull() & F.col("date").isNotNull()
    return (
        per_date.withColumn("mau", F.when(known, F.sum("change").over(so_far)))
        .filter("dau > 0")
        .drop("change")
    )


def daily_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy(F.col("session_date").alias("date"), "platform").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.avg("session_duration_sec").alias("avg_session_duration_sec"),
        F.avg("total_engagement_sec").alias("avg_engagement_sec"),
        F.avg("events_count").alias("avg_events_per_session"),
        F.avg("levels_completed").alias("avg_levels_per_session"),
    )


def daily_new_users(users: DataFrame) -> DataFrame:
    return users.groupBy(F.col("install_date").alias("date"), "platform").agg(
        F.count(F.lit(1)).alias("new_users")
    )


def mart_daily_kpis(
    events: DataFrame, sessions: DataFrame, users: DataFrame, days: int = 30
) -> DataFrame:
    day = ["date", "platform"]
    joined = (
        _daily_and_rolling(events, days)
        .join(daily_sessions(sessions), day, "left")
        .join(daily_new_users(users), day, "left")
    )

    def or_zero(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).alias(column)

    return joined.select(
        "date",
        "platform",
        "dau",
        or_zero("mau"),
        ratio(F.col("dau"), F.col("mau")).alias("stickiness"),
        "paying_users",
        "total_revenue",
        ratio(F.col("total_revenue"), F.col("dau")).alias("arpu"),
        ratio(F.col("total_revenue"), F.col("paying_users")).alias("arppu"),
        ratio(F.col("paying_users"), F.col("dau")).alias("payer_conversion_rate"),
        "total_events",
        or_zero("total_sessions"),
        ratio(F.col("total_sessions"), F.col("dau")).alias("sessions_per_dau"),
        or_zero("avg_session_duration_sec"),
        or_zero("avg_engagement_sec"),
        or_zero("avg_events_per_session"),
        or_zero("avg_levels_per_session"),
        or_zero("new_users"),
    )


def mart_retention_cohorts(
    users: DataFrame, events: DataFrame, days: Sequence[int] = RETENTION_DAYS
) -> DataFrame:
    """Cohort size and the players who came back exactly n days after install."""
    cohort = ["cohort_date", "platform", "traffic_source"]
    installs = users.select(
        PLAYER, F.col("install_date").alias("cohort_date"), "platform", "traffic_source"
    )
    active = events.select(PLAYER, "event_date").distinct()
    age = F.datediff("event_date", "cohort_date")
    per_player = (
        installs.join(active, PLAYER)
        .filter(F.col("event_date") >= F.col("cohort_date"))
        .groupBy(*cohort, PLAYER)
        .agg(
            F.max((age == 0).cast("int")).alias("d0"),
            *[F.max((age == n).cast("int")).alias(f"d{n}") for n in days],
        )
    )
    counts = per_player.groupBy(*cohort).agg(
        F.sum("d0").alias("cohort_size"), *[F.sum(f"d{n}").alias(f"d{n}_users") for n in days]
    )
    return counts.select(
        *cohort,
        "cohort_size",
        *[f"d{n}_users" for n in days],
        *[
            ratio(F.col(f"d{n}_users"), F.col("cohort_size")).alias(f"d{n}_retention")
            for n in days
        ],
    ).orderBy(F.desc("cohort_date"))


def mart_revenue_daily(revenue: DataFrame) -> DataFrame:
    """``unique_payers`` counts every player with a revenue row, also of zero value."""
    return revenue.groupBy(F.col("event_date").alias("date"), "platform", "revenue_type").agg(
        F.countDistinct(PLAYER).alias("unique_payers"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("revenue_amount").alias("total_revenue"),
        F.avg("revenue_amount").alias("avg_transaction_value"),
    )


def mart_player_segments(users: DataFrame) -> DataFrame:
    """RFM quartiles and rule segments. ``users`` is read several times: pass a stored table.

    Ties are ordered by player and account. Revenue is compared at six decimals, so the order in
    which a sum was added up does not move a player between quartiles.
    """
    metrics = users.filter(F.col("lifetime_days") >= 0)

    def by(value: Column) -> Ordering:
        return Ordering([value.cast("double"), F.col(PLAYER), F.col("user_id")])

    quartile = ntiles(
        metrics,
        {
            "recency_score": by(-F.col("days_since_last_active")),
            "frequency_score": by(F.col("active_days")),
            "monetary_score": by(F.round("total_revenue", 6)),
        },
        4,
    )
    scored = metrics.select(
        PLAYER,
        "platform",
        "geo_country",
        "install_date",
        "total_revenue",
        "purchase_count",
        "active_days",
        "days_since_last_active",
        "lifetime_days",
        "max_level",
        "total_engagement_minutes",
        "total_events",
        *[score.alias(name) for name, score in quartile.items()],
    )
    pays = F.col("total_revenue") > 0
    segment = (
        F.when(pays & (F.col("monetary_score") == 4) & (F.col("purchase_count") >= 5), "whale")
        .when(pays & (F.col("monetary_score") >= 3), "dolphin")
        .when(pays, "minnow")
        .when(F.col("days_since_last_active") > 14, "churned")
        .when((F.col("days_since_last_active") > 7) & (F.col("recency_score") <= 2), "at_risk")
        .when((F.col("frequency_score") >= 3) & (F.col("active_days") >= 5), "engaged_free")
        .otherwise("casual")
    )
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return scored.select("*", total.alias("rfm_total"), segment.alias("player_segment"))


def mart_session_stats(sessions: DataFrame) -> DataFrame:
    """Session statistics per (date, platform). A session of exactly 300 s is in two buckets."""
    day = [F.col("session_date").alias("date"), "platform"]
    length = F.col("session_duration_sec")
    stats = sessions.groupBy(*day).agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.countDistinct(PLAYER).alias("unique_users"),
        F.avg(length).alias("avg_duration_sec"),
        F.avg("total_engagement_sec").alias("avg_engagement_sec"),
        F.avg("events_count").alias("avg_events_per_session"),
        F.avg("levels_completed").alias("avg_levels_per_session"),
        F.sum("session_revenue").alias("total_session_revenue"),
        F.count_if(length < 60).alias("sessions_under_1min"),
        F.count_if(length.between(60, 300)).alias("sessions_1_5min"),
        F.count_if(length.between(300, 900)).alias("sessions_5_15min"),
        F.count_if(length > 900).alias("sessions_over_15min"),
    )
    # From counts of each length, as a sketch is off by a rank or more in a day with many sessions.
    lengths = sessions.groupBy(*day, length).agg(F.count(F.lit(1)).alias("_n"))
    medians = observed_quantiles(
        lengths, ["date", "platform"], "session_duration_sec", "_n", {"median_duration_sec": 0.5}
    )
    same_day = stats["date"].eqNullSafe(medians["date"]) & stats["platform"].eqNullSafe(
        medians["platform"]
    )
    return stats.join(medians, same_day, "left").select(
        stats["date"],
        stats["platform"],
        "total_sessions",
        "unique_users",
        "avg_duration_sec",
        "median_duration_sec",
        "avg_engagement_sec",
        "avg_events_per_session",
        "avg_levels_per_session",
        "total_session_revenue",
        "sessions_under_1min",
        "sessions_1_5min",
        "sessions_5_15min",
        "sessions_over_15min",
    )


def mart_level_funnel(levels: DataFrame, users: DataFrame) -> DataFrame:
    """Completions per level. Attempts that failed outright do not count."""
    done = levels.filter(
        F.col("event_name").isin(*COMPLETION_EVENTS)
        & (F.col("success").isNull() | (F.col("success") == "true"))
        & F.col("level_number").isNotNull()
    )
    per_player = done.groupBy(PLAYER, "level_number").agg(
        F.min("event_date").alias("first_completed_date"),
        F.count(F.lit(1)).alias("attempts"),
        F.max("score").alias("best_score"),
    )
    total = users.agg(F.countDistinct(PLAYER)).scalar()
    waited = F.datediff("first_completed_date", "install_date")
    return (
        per_player.join(users.select(PLAYER, "install_date"), PLAYER)
        .groupBy("level_number")
        .agg(
            F.countDistinct(PLAYER).alias("users_completed"),
            F.avg("attempts").alias("avg_attempts"),
            F.avg("best_score").alias("avg_best_score"),
            F.avg(waited).alias("avg_days_to_complete"),
        )
        .withColumn("total_users", total)
        .select(
            "level_number",
            "users_completed",
            "total_users",
            ratio(F.col("users_completed"), F.col("total_users")).alias("completion_rate"),
            "avg_attempts",
            "avg_best_score",
            "avg_days_to_complete",
        )
        .orderBy("level_number")
    )


def mart_geo_stats(users: DataFrame) -> DataFrame:
    """Per country. Averages are over dimension rows, counts over players."""
    place = ["geo_country", "geo_continent"]
    averaged = ("active_days", "max_level", "total_engagement_minutes")
    per_player = users.groupBy(*place, PLAYER).agg(
        F.max("is_payer").alias("pays"),
        F.sum("total_revenue").alias("total_revenue"),
        *[F.sum(c).alias(f"sum_{c}") for c in averaged],
        *[F.count(c).alias(f"n_{c}") for c in averaged],
    )

    def mean(column: str) -> Column:
        return ratio(F.sum(f"sum_{column}"), F.sum(f"n_{column}"))

    return (
        per_player.groupBy(*place)
        .agg(
            F.count(PLAYER).alias("total_users"),
            F.count_if("pays").alias("payers"),
            F.sum("total_revenue").alias("total_revenue"),
            mean("active_days").alias("avg_active_days"),
            mean("max_level").alias("avg_level"),
            mean("total_engagement_minutes").alias("avg_engagement_min"),
        )
        .withColumn("payer_rate", ratio(F.col("payers"), F.col("total_users")))
        .orderBy(F.desc("total_users"), "geo_country")
    )
