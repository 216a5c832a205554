"""Sketches of days against exact counts and quantiles, beyond the sizes at which they are exact."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from playerlens.operators import marts, sketches

FIRST = date(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    day = F.date_add(F.lit(FIRST), F.pmod(F.xxhash64("id"), F.lit(40)).cast("int"))
    return (
        spark.range(400_000)
        .select(
            day.alias("event_date"),
            F.when(F.col("id") % 3 == 0, "ios").otherwise("android").alias("platform"),
            F.concat(F.lit("p"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(90_000))).alias("user_pseudo_id"),
        )
        .cache()
    )


def test_rolling_counts_stay_within_the_error(events):
    exact = {(r["date"], r["platform"]): r["mau"] for r in marts.rolling_active(events).collect()}
    days = sketches.day_activity(events)
    got = {(r["date"], r["platform"]): r["mau"] for r in sketches.rolling_active(days).collect()}
    assert set(got) == set(exact) and max(exact.values()) > 2 * (1 << sketches.LG)
    error = sketches.distinct_error()
    assert all(abs(got[k] - n) <= error * n for k, n in exact.items())
    small = [k for k, n in exact.items() if n < 1 << sketches.LG]
    assert small and all(got[k] == exact[k] for k in small)


def test_quantiles_of_a_range_stay_within_the_error(spark):
    sessions = spark.range(300_000).select(
        F.date_add(F.lit(FIRST), (F.col("id") % 50).cast("int")).alias("date"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) * F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000))).alias("score"),
    )
    levels = sessions.selectExpr("date AS event_date", "'post_score' AS event_name", "score", "1L AS level_number", "'a' AS user_pseudo_id")
    for k in (64, sketches.K):
        days = sketches.day_scores(levels, k=k)
        row = sketches.score_distribution(days, date(2024, 1, 8), date(2024, 2, 10), k=k).first()
        inside = [r[0] for r in sessions.filter("date BETWEEN '2024-01-08' AND '2024-02-10'").select("score").collect()]
        for q, name in ((0.25, "q25_score"), (0.5, "median_score"), (0.75, "q75_score")):
            below = sum(x < row[name] for x in inside) / len(inside)
            upto = sum(x <= row[name] for x in inside) / len(inside)
            assert below - sketches.rank_error(k) <= q <= upto + sketches.rank_error(k)
        assert (row["min_score"], row["max_score"]) == (min(inside), max(inside))
        assert row["avg_score"] == pytest.approx(sum(inside) / len(inside))


def test_late_rows_are_merged_into_their_day(events):
    late = F.pmod(F.xxhash64("user_pseudo_id"), F.lit(5)) == 0
    keys = ["date", "platform"]
    days = sketches.merged(sketches.day_activity(events.filter(~late)), sketches.day_activity(events.filter(late)), keys)
    whole = sketches.day_activity(events)
    read = lambda df: {(r["date"], r["platform"]): (r["events"], r["n"]) for r in df.withColumn("n", F.theta_sketch_estimate("players")).collect()}
    assert read(days) == read(whole)


def test_the_marts_read_their_input_once(spark):
    rows = spark.createDataFrame([], "session_date date, platform string, user_pseudo_id string, session_duration_sec bigint, total_engagement_sec double, events_count bigint, levels_completed bigint, session_revenue double")
    days = sketches.day_sessions(rows)
    plan = sketches.session_stats(days)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and plan.count("Exchange") == 1
    assert sketches.session_stats(days).collect() == []
    assert sketches.active_between(spark.createDataFrame([], "date date, platform string, events bigint, players binary")).first()["unique_users"] == 0


def test_days_without_values(spark):
    rows = spark.createDataFrame(
        [(FIRST, "ios", "a", None, 1.0, 2, 0, 0.0), (FIRST, None, "a", 5, 1.0, 2, 0, 0.0)],
        "session_date date, platform string, user_pseudo_id string, session_duration_sec bigint, total_engagement_sec double, events_count bigint, levels_completed bigint, session_revenue double",
    )
    got = {r["platform"]: r for r in sketches.session_stats(sketches.day_sessions(rows)).collect()}
    assert got["ios"]["median_duration_sec"] is None and got["ios"]["avg_duration_sec"] is None
    assert got[None]["median_duration_sec"] == 5
    lengths = {r["platform"]: r["p50"] for r in sketches.session_lengths(sketches.day_sessions(rows)).collect()}
    assert lengths == {"ios": None, None: 5}
