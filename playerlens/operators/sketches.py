"""Distinct counts and quantiles of any range of days, from one small sketch for each day.

A day's table row holds a theta sketch of its players and KLL sketches of its values. Sketches of
days are merged without going back to the events, and late rows are merged into their day. Both are
exact while few values are in them: a theta sketch up to ``2**lg`` players, a KLL sketch up to ``k``
values. Beyond, the errors are those of ``distinct_error`` and ``rank_error``. The exact forms are in
``marts`` and ``dashboards``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAYER = "user_pseudo_id"
LG = 14
K = 4096
#: Constant and exponent of the published rank error of KLL sketches, at 99 % confidence.
_KLL_ERROR = (2.296, 0.9021)


def distinct_error(lg: int = LG, deviations: float = 3) -> float:
    """Relative error of a distinct count that has 2**lg samples left."""
    return deviations / sqrt((1 << lg) - 1)


def rank_error(k: int = K) -> float:
    """How far, as a share of all values, a quantile's rank may be off."""
    constant, exponent = _KLL_ERROR
    return constant / k**exponent


def _distinct(sketch: Column | str, lg: int) -> Column:
    return F.theta_sketch_estimate(F.theta_union_agg(sketch, lg)).cast("bigint")


def _between(sketches: DataFrame, first: date | None, last: date | None) -> DataFrame:
    rows = sketches
    if first is not None:
        rows = rows.filter(F.col("date") >= F.lit(first))
    if last is not None:
        rows = rows.filter(F.col("date") <= F.lit(last))
    return rows


def merged(sketches: DataFrame, more: DataFrame, keys: Sequence[str], lg: int = LG, k: int = K) -> DataFrame:
    """Both tables as one: counts and sums are added, extremes and sketches merged, key by key.

    Columns are told apart by their names: ``players`` is a theta sketch, other binary columns are
    KLL sketches, ``min_`` and ``max_`` begin extremes.
    """

    def both(c: str, kind: str) -> Column:
        if c == "players":
            return F.theta_union_agg(c, lg)
        if kind == "binary":
            return F.kll_merge_agg_bigint(c, k)
        if c.startswith("min_"):
            return F.min(c)
        return F.max(c) if c.startswith("max_") else F.sum(c)

    rows = sketches.unionByName(more)
    out = [both(c, kind).alias(c) for c, kind in sketches.dtypes if c not in keys]
    return rows.groupBy(*keys).agg(*out).select(*sketches.columns)


# Players ------------------------------------------------------------------------------------


def day_activity(events: DataFrame, lg: int = LG) -> DataFrame:
    """One row per day and platform: ``date, platform, events, players``."""
    return events.groupBy(F.col("event_date").alias("date"), "platform").agg(
        F.count(F.lit(1)).alias("events"), F.theta_sketch_agg(PLAYER, lg).alias("players")
    )


def rolling_active(activity: DataFrame, days: int = 30, lg: int = LG) -> DataFrame:
    """Distinct players of the trailing ``days`` for each (date, platform) with activity.

    A window over the days of a platform; no event is read.
    """
    trailing = (
        f"theta_sketch_estimate(theta_union_agg(players, {lg}) OVER (PARTITION BY platform "
        f"ORDER BY date RANGE BETWEEN INTERVAL {days - 1} DAYS PRECEDING AND CURRENT ROW))"
    )
    known = activity.filter(F.col("platform").isNotNull() & F.col("date").isNotNull())
    return known.selectExpr("date", "platform", f"CAST({trailing} AS BIGINT) AS mau")


def active_between(
    activity: DataFrame, first: date | None = None, last: date | None = None, lg: int = LG
) -> DataFrame:
    """One row: first and last day with events, events and distinct players of a range of days."""
    return _between(activity, first, last).agg(
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
        F.coalesce(_distinct("players", lg), F.lit(0)).alias("unique_users"),
    )


# Values -------------------------------------------------------------------------------------


def _quantiles(sketch: Column | str, probabilities: Sequence[float]) -> list[Column]:
    sketch = F.col(sketch) if isinstance(sketch, str) else sketch
    some = F.kll_sketch_get_n_bigint(sketch) > 0
    return [F.when(some, F.kll_sketch_get_quantile_bigint(sketch, F.lit(p))) for p in probabilities]


def day_sessions(sessions: DataFrame, lg: int = LG, k: int = K) -> DataFrame:
    """One row per day and platform: what ``session_stats`` needs, from one pass over sessions."""
    length = F.col("session_duration_sec")
    return sessions.groupBy(F.col("session_date").alias("date"), "platform").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.theta_sketch_agg(PLAYER, lg).alias("players"),
        F.count(length).alias("lengths"),
        F.sum(length).alias("duration_sec"),
        F.sum("total_engagement_sec").alias("engagement_sec"),
        F.sum("events_count").alias("events"),
        F.sum("levels_completed").alias("levels"),
        F.sum("session_revenue").alias("total_session_revenue"),
        F.count_if(length < 60).alias("sessions_under_1min"),
        F.count_if(length.between(60, 300)).alias("sessions_1_5min"),
        F.count_if(length.between(300, 900)).alias("sessions_5_15min"),
        F.count_if(length > 900).alias("sessions_over_15min"),
        F.kll_sketch_agg_bigint(length.cast("bigint"), k).alias("length_sketch"),
    )


def session_stats(days: DataFrame) -> DataFrame:
    """``marts.mart_session_stats`` from the sketches of ``day_sessions``."""
    mean = lambda c: F.col(c).cast("double") / F.col("total_sessions")
    median = _quantiles("length_sketch", [0.5])[0]
    return days.select(
        "date",
        "platform",
        "total_sessions",
        F.theta_sketch_estimate("players").cast("bigint").alias("unique_users"),
        F.try_divide(F.col("duration_sec").cast("double"), F.col("lengths")).alias("avg_duration_sec"),
        median.alias("median_duration_sec"),
        mean("engagement_sec").alias("avg_engagement_sec"),
        mean("events").alias("avg_events_per_session"),
        mean("levels").alias("avg_levels_per_session"),
        "total_session_revenue",
        "sessions_under_1min",
        "sessions_1_5min",
        "sessions_5_15min",
        "sessions_over_15min",
    )


def session_lengths(
    days: DataFrame,
    first: date | None = None,
    last: date | None = None,
    probabilities: Sequence[float] = (0.5,),
    k: int = K,
) -> DataFrame:
    """Quantiles of session length per platform over a range of days, as ``p50`` and the like."""
    whole = _between(days, first, last).groupBy("platform").agg(
        F.sum("total_sessions").alias("sessions"), F.kll_merge_agg_bigint("length_sketch", k).alias("_s")
    )
    names = [f"p{100 * p:g}".replace(".", "_") for p in probabilities]
    found = [q.alias(n) for q, n in zip(_quantiles("_s", probabilities), names, strict=True)]
    return whole.select("platform", "sessions", *found)


def day_scores(levels: DataFrame, lg: int = LG, k: int = K) -> DataFrame:
    """One row per day and level with posted scores."""
    scores = levels.filter(
        (F.col("event_name") == "post_score") & F.col("score").isNotNull() & F.col("level_number").isNotNull()
    )
    return scores.groupBy(F.col("event_date").alias("date"), "level_number").agg(
        F.count(F.lit(1)).alias("scores"),
        F.sum("score").alias("total_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.theta_sketch_agg(PLAYER, lg).alias("players"),
        F.kll_sketch_agg_bigint("score", k).alias("score_sketch"),
    )


def score_distribution(
    days: DataFrame, first: date | None = None, last: date | None = None, lg: int = LG, k: int = K
) -> DataFrame:
    """``dashboards.score_distribution`` of a range of days, from the sketches of ``day_scores``."""
    whole = _between(days, first, last).groupBy("level_number").agg(
        F.sum("scores").alias("_n"),
        F.sum("total_score").alias("_total"),
        F.min("min_score").alias("min_score"),
        F.max("max_score").alias("max_score"),
        _distinct("players", lg).alias("players"),
        F.kll_merge_agg_bigint("score_sketch", k).alias("_s"),
    )
    low, middle, high = _quantiles("_s", [0.25, 0.5, 0.75])
    return whole.select(
        "level_number",
        "players",
        "min_score",
        low.alias("q25_score"),
        middle.alias("median_score"),
        high.alias("q75_score"),
        "max_score",
        (F.col("_total").cast("double") / F.col("_n")).alias("avg_score"),
    ).orderBy("level_number")
