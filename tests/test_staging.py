from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from playerlens import schemas
from playerlens.functions.columns import event_param, risk_tier, sunday_week, week_label
from playerlens.operators import staging, warehouse
from playerlens.sources import normalize

START = datetime(2024, 3, 1, 12)


def raw_rows(spark, rows):
    """Raw events from dicts; columns that are not given are NULL."""
    names = schemas.RAW_EVENTS.fieldNames()
    filled = []
    for r in rows:
        r = {"_ingestion_timestamp": START, "platform": "IOS", "event_name": "level_start", **r}
        if "event_date" not in r and r.get("event_timestamp"):
            r["event_date"] = r["event_timestamp"].date()
        filled.append(tuple(r.get(n) for n in names))
    return spark.createDataFrame(filled, schemas.RAW_EVENTS)


def at(player, seconds, **more):
    return {
        "user_pseudo_id": player,
        "event_timestamp": START + timedelta(seconds=seconds),
        **more,
    }


SESSION_MAKERS = [staging.stg_sessions, staging.stg_sessions_windowed]


@pytest.mark.parametrize("make", SESSION_MAKERS)
@pytest.mark.parametrize(
    "gap, sessions",
    [(30 * 60, 1), (30 * 60 + 59.999999, 1), (31 * 60, 2), (31 * 60 + 0.000001, 2), (0.5, 1)],
)
def test_session_gap_counts_whole_minutes(spark, make, gap, sessions):
    # The offset moves the pair over the borders of the clock slices.
    for offset in (0, 17 * 60, 29 * 60 + 59.9):
        raw = raw_rows(spark, [at("a", offset), at("a", offset + gap), at("b", offset)])
        got = make(staging.stg_events(raw)).groupBy("user_pseudo_id").count().collect()
        assert {r[0]: r[1] for r in got} == {"a": sessions, "b": 1}


def test_chain_of_short_gaps_is_one_session(spark):
    raw = raw_rows(spark, [at("a", k * 29 * 60) for k in range(40)])
    events = staging.stg_events(raw)
    session = staging.stg_sessions(events).collect()
    assert len(session) == 1
    assert session[0]["session_duration_sec"] == 39 * 29 * 60
    assert session[0]["events_count"] == 40
    gaps = [r["minutes_since_prev"] for r in staging.assign_sessions(events).collect()]
    assert sorted(gaps, key=lambda g: -1 if g is None else g) == [None] + [29] * 39


def test_sessions_match_a_window_per_player(spark):
    """Against lag and a running sum over whole players, on random event times."""
    rows = spark.range(4000).select(
        F.concat(F.lit("p"), (F.pmod(F.xxhash64("id"), F.lit(7))).cast("string")).alias("p"),
        F.timestamp_micros(
            F.lit(1709290800000000)
            + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40 * 86400 * 1000000))
        ).alias("t"),
    )
    events = staging.stg_events(
        raw_rows(spark, [at("x", 0)])
        .limit(0)
        .unionByName(
            rows.select(
                F.col("p").alias("user_pseudo_id"),
                F.col("t").alias("event_timestamp"),
                F.to_date("t").alias("event_date"),
                F.lit("level_up").alias("event_name"),
            ),
            allowMissingColumns=True,
        )
    )
    events.createOrReplaceTempView("one_stream")
    expected = spark.sql(
        """
        SELECT user_pseudo_id, num, min(event_timestamp), max(event_timestamp), count(*)
        FROM (SELECT *, sum(IF(gap IS NULL OR gap > 30, 1, 0)) OVER (
                PARTITION BY user_pseudo_id ORDER BY event_timestamp) AS num
              FROM (SELECT *, timestampdiff(MINUTE, lag(event_timestamp) OVER (
                      PARTITION BY user_pseudo_id ORDER BY event_timestamp), event_timestamp) AS gap
                    FROM one_stream))
        GROUP BY user_pseudo_id, num
        """
    ).collect()
    expected = {(r[0], r[2], r[3], r[4]) for r in expected}
    for make in SESSION_MAKERS:
        got = make(events).select(
            "user_pseudo_id", "session_start", "session_end", "events_count"
        )
        assert {tuple(r) for r in got.collect()} == expected
    assert sum(e[3] for e in expected) == events.count()


def test_dedup_keeps_the_newest_and_breaks_ties(spark):
    later = START + timedelta(hours=1)
    raw = raw_rows(
        spark,
        [
            at("a", 0, param_level=9),
            at("a", 0, param_level=1, _ingestion_timestamp=later),
            at("b", 0, param_level=1),
            at("b", 0, param_level=None),
            at("b", 0, param_level=3),
            {"event_timestamp": START},
            {"user_pseudo_id": "c"},
        ],
    )
    got = staging.stg_events(raw).select("user_pseudo_id", "param_level").collect()
    assert sorted(map(tuple, got)) == [("a", 1), ("b", 3)]


@pytest.mark.parametrize("sessions", SESSION_MAKERS)
def test_event_types_of_a_session_are_counted_by_bitmaps(spark, sessions):
    """More names than a word has bits, repeated in one slice and over several."""
    rows = [at("a", 60 * (i // 3), event_name=f"e{i % 150:03}") for i in range(400)]
    rows += [at("b", 0, event_name="e000"), at("b", 1, event_name="e000"), at("c", 0, event_name="e149")]
    events = staging.stg_events(raw_rows(spark, rows))
    made = sessions(events)
    got = {r["user_pseudo_id"]: r["unique_event_types"] for r in made.collect()}
    assert got == {"a": 150, "b": 1, "c": 1}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "collect_" not in plan and "bit_or" in plan
    assert sessions(events.limit(0)).count() == 0


def test_first_touch_keeps_nulls_of_the_first_event(spark):
    raw = raw_rows(
        spark,
        [at("a", 0, device_os=None, traffic_campaign=None), at("a", 5, device_os="ios")],
    )
    touch = warehouse.first_touch(staging.stg_events(raw)).first()
    assert touch["device_os"] is None and touch["traffic_source"] == "direct"


def test_dim_users_per_account_or_per_player(spark):
    raw = raw_rows(
        spark, [at("a", 0, user_id="one"), at("a", 90000, user_id="two"), at("a", 90001)]
    )
    events = staging.stg_events(raw)
    accounts = warehouse.dim_users(events, date(2024, 3, 9)).collect()
    assert sorted(r["user_id"] for r in accounts) == ["a", "one", "two"]
    assert {r["total_events"] for r in accounts} == {3}
    assert {r["days_since_last_active"] for r in accounts} == {7}
    one = warehouse.dim_users(events, date(2024, 3, 9), one_row_per_player=True).collect()
    assert [(r["user_id"], r["lifetime_days"]) for r in one] == [("one", 1)]


def test_level_actions(spark):
    raw = raw_rows(
        spark,
        [
            at("a", 1, event_name="level_end", param_success="true"),
            at("a", 2, event_name="level_end", param_success="false"),
            at("a", 3, event_name="level_end"),
            at("a", 4, event_name="level_complete"),
            at("a", 5, event_name="ad_click", event_value_in_usd=0.5),
            at("a", 6, event_name="user_engagement", event_value_in_usd=0.5),
        ],
    )
    events = staging.stg_events(raw)
    actions = [r["level_action"] for r in warehouse.fact_levels(events).collect()]
    assert sorted(actions) == ["level_complete", "level_end", "lost", "won"]
    kinds = [r["revenue_type"] for r in warehouse.fact_revenue(events).collect()]
    assert sorted(kinds) == ["ad", "other"]


def test_calendar_labels(spark):
    days = warehouse.dim_dates(spark, date(2018, 1, 1), date(2019, 12, 31))
    assert days.count() == 730
    rows = {r["date_key"]: r for r in days.collect()}
    for day, row in rows.items():
        assert row["week_of_year"] == int(day.strftime("%U"))
        assert row["year_week"] == day.strftime("%Y-W%V")
    last = days.filter("date_key = '2018-12-31'")
    assert last.select(week_label(F.col("date_key"), iso_year=True)).first()[0] == "2019-W01"
    assert last.select(sunday_week(F.col("date_key"))).first()[0] == 52


def test_repeated_and_missing_params(spark):
    row = spark.createDataFrame(
        [([("level", (None, 3, None)), ("level", (None, 4, None))],), ([],), (None,)],
        "event_params ARRAY<STRUCT<key: STRING, value: STRUCT<string_value: STRING, "
        "int_value: BIGINT, double_value: DOUBLE>>>",
    )
    got = [r[0] for r in row.select(event_param("level", "int_value")).collect()]
    assert got == [3, None, None]
    assert [tuple(r) for r in normalize.repeated_params(row).collect()] == [("level", 1)]


def test_session_id_from_either_slot(spark):
    text = "STRUCT<string_value: STRING, int_value: BIGINT, double_value: DOUBLE>"
    base = spark.createDataFrame([], schemas.NESTED_EVENTS).columns
    nested = spark.createDataFrame(
        [([("ga_session_id", (None, 77, None))],), ([("ga_session_id", ("s", None, None))],)],
        f"event_params ARRAY<STRUCT<key: STRING, value: {text}>>",
    )
    for c in base:
        if c != "event_params":
            kind = schemas.NESTED_EVENTS[c].dataType
            nested = nested.withColumn(c, F.lit(None).cast(kind))
    flat = normalize.flatten_events(nested.withColumn("suffix", F.lit("20240301")))
    assert [r["param_session_id"] for r in flat.collect()] == ["77", "s"]
    assert flat.columns == schemas.RAW_EVENTS.fieldNames()


def test_risk_tier_edges(spark):
    edges = [0.0, 1e-9, 0.2, 0.21, 0.4, 0.6, 0.8, 1.0, None]
    df = spark.createDataFrame([(e,) for e in edges], "p DOUBLE")
    assert [r[0] for r in df.select(risk_tier(F.col("p"))).collect()] == [
        None, "very_low", "very_low", "low", "low", "medium", "high", "very_high", None,
    ]
