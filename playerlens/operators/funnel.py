"""Drop-off analysis on top of the level funnel. Works on one row per level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playerlens.functions.columns import round_double

# What makes a drop severe or a warning, as a multiple of the mean drop, or in
# percentage points of the player base.
RELATIVE_SEVERE, RELATIVE_WARNING = 2.0, 1.5
ABSOLUTE_SEVERE, ABSOLUTE_WARNING = 8.0, 4.0
MANY_ATTEMPTS = 4


def level_funnel_enriched(funnel: DataFrame, severity_mode: str = "relative") -> DataFrame:
    """Adds drop rates, difficulty, pacing and severity to the funnel.

    ``relative`` grades a drop against the mean drop of all levels, and the first level has none.
    ``absolute`` grades it in percentage points, and measures the first level from 100 %.
    Each rounded column feeds the next one in rounded form.
    """
    if severity_mode not in ("relative", "absolute"):
        raise ValueError(f"unknown severity_mode: {severity_mode}")
    absolute = severity_mode == "absolute"
    # One row per level: a single ordered pass over them is small.
    by_level = Window.orderBy("level_number")
    rate, before = F.col("completion_rate"), F.col("prev_completion_rate")
    lag_rate = (
        F.lag("completion_rate", 1, 1.0) if absolute else F.lag("completion_rate")
    ).over(by_level)
    waited = F.col("avg_days_to_complete") - F.lag("avg_days_to_complete").over(by_level)

    dropped = funnel.withColumns({"prev_completion_rate": lag_rate, "_waited": waited}).withColumns(
        {
            "drop_rate": round_double(F.coalesce(before - rate, F.lit(0.0)), 4),
            "_relative": round_double(F.try_divide(before - rate, before), 4),
            "_difficulty": round_double(F.col("avg_attempts") * (1 - rate), 4),
            "pacing_gap": round_double(F.coalesce("_waited", F.lit(0.0)), 2),
        }
    )
    averaged = dropped.withColumn(
        "avg_drop_rate", round_double(F.avg("drop_rate").over(Window.partitionBy()), 4)
    )
    multiple = F.try_divide("drop_rate", "avg_drop_rate")
    points = round_double(F.col("drop_rate") * 100, 2)
    severe, warning = (
        (points > ABSOLUTE_SEVERE, points > ABSOLUTE_WARNING)
        if absolute
        else (multiple >= RELATIVE_SEVERE, multiple >= RELATIVE_WARNING)
    )

    def grade(if_severe, if_warning, otherwise) -> Column:
        return F.when(severe, if_severe).when(warning, if_warning).otherwise(otherwise)

    return averaged.select(
        "level_number",
        "users_completed",
        "total_users",
        round_double(rate * 100, 2).alias("completion_rate_pct"),
        "completion_rate",
        "avg_attempts",
        "avg_best_score",
        "avg_days_to_complete",
        "prev_completion_rate",
        points.alias("drop_rate_pct_display"),
        "drop_rate",
        round_double(F.col("_relative") * 100, 2).alias("relative_drop_pct"),
        round_double(F.col("avg_drop_rate") * 100, 2).alias("avg_drop_rate_pct"),
        "avg_drop_rate",
        round_double(multiple, 2).alias("drop_vs_avg"),
        round_double(F.col("_difficulty") * 100, 2).alias("difficulty_index"),
        "pacing_gap",
        grade("severe", "warning", "normal").alias("severity"),
        grade(1, 2, 3).alias("severity_order"),
        round_double(F.col("drop_rate") * F.col("total_users"), 0).alias("players_lost"),
    ).orderBy("level_number")


def funnel_scorecard(enriched: DataFrame, lowest: int, highest: int) -> DataFrame:
    """Headline numbers of a level range, in one row. The last of equally bad levels is named."""
    level, drop = F.col("level_number"), F.col("drop_rate_pct_display")
    return enriched.filter(level.between(lowest, highest)).agg(
        F.count(F.lit(1)).alias("total_levels"),
        round_double(F.avg(drop), 2).alias("avg_drop_pct"),
        F.count_if(F.col("severity") == "severe").alias("severe_drops"),
        F.count_if(F.col("severity") == "warning").alias("warning_drops"),
        F.max_by(level, F.struct(drop, level)).alias("worst_level"),
        F.max(drop).alias("worst_drop_pct"),
        F.max_by("completion_rate_pct", level).alias("end_of_funnel_pct"),
    )


def problem_levels(enriched: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` hardest levels among those with a severe or warning drop."""
    # What to do about a level.
    action = (
        F.when(F.col("severity") != "severe", "Monitor / Tune")
        .when(F.col("avg_attempts") > MANY_ATTEMPTS, "Nerf difficulty")
        .otherwise("Redesign UX")
    )
    return (
        enriched.filter(F.col("severity") != "normal")
        .orderBy(F.desc("difficulty_index"), "level_number")
        .limit(n)
        .select(
            "level_number",
            "completion_rate_pct",
            "drop_rate_pct_display",
            "avg_attempts",
            "avg_best_score",
            "avg_days_to_complete",
            "difficulty_index",
            "severity",
            action.alias("suggested_action"),
        )
    )


def cliff_report(enriched: DataFrame, cliffs: dict[int, str]) -> DataFrame:
    """Drop, losses, attempts and completion of named levels; a level without data stays empty."""
    named = enriched.sparkSession.createDataFrame(
        sorted(cliffs.items()), "level_number BIGINT, cliff STRING"
    )
    lost = round_double(F.col("total_users") * F.col("drop_rate_pct_display") / 100, 0)
    return (
        named.join(enriched, "level_number", "left")
        .select(
            "level_number",
            "cliff",
            "drop_rate_pct_display",
            lost.alias("players_lost"),
            "avg_attempts",
            "completion_rate_pct",
        )
        .orderBy("level_number")
    )
