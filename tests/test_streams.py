"""Streams over several micro-batches: state that is replaced, expires, and survives retries."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from playerlens import schemas
from playerlens.operators import staging
from playerlens.streaming import streams

KEYED = "appsflyer_id string, event_time timestamp, event_name string, _ingestion_timestamp timestamp, value int"
DAY = datetime(2024, 1, 1)


def report(key, day, loaded, value):
    time = None if day is None else DAY + timedelta(days=day)
    return (key, time, "e", DAY + timedelta(days=loaded), value)


def run(spark, tmp_path, parts, build):
    """The rows that each part makes the stream put out, and its progress."""
    source, target, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    seen, out, progress = set(), [], []
    for rows in parts:
        spark.createDataFrame(rows, KEYED).coalesce(1).write.mode("append").parquet(source)
        stream = build(spark.readStream.schema(KEYED).parquet(source))
        query = (
            stream.writeStream.outputMode("append")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .format("parquet")
            .start(target)
        )
        query.awaitTermination()
        progress.append(query.lastProgress)
        now = {(r["appsflyer_id"], r["value"]) for r in spark.read.parquet(target).collect()}
        out.append(now - seen)
        seen |= now
    return out, progress


def test_newest_copy_comes_out_once_after_the_delay(spark, tmp_path):
    streams.keep_state_on_disk(spark)
    parts = [
        [report("a", 0, 1, 1), report("b", 0, 1, 2), report(None, 0, 1, 9)],
        [report("a", 0, 3, 3), report("b", 0, 0.5, 4), report("c", 1, 1, 5)],
        [report("d", 4, 4, 6)],
        [report("a", 0, 9, 7), report("c", 1, 9, 8), report("e", 9, 9, 10), report("t", None, 9, 11)],
    ]
    out, progress = run(
        spark, tmp_path, parts, lambda s: streams.stream_newest(s, schemas.ATTRIBUTION_EVENTS, "2 days")
    )
    assert out == [set(), set(), {("a", 3), ("b", 2), (None, 9), ("c", 5)}, {("d", 6)}]
    states = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert states == [3, 4, 1, 2]  # what came out has left; e, and the row without a time, stay


def test_newest_is_the_batch_choice_among_equally_new_copies(spark, tmp_path):
    rows = [report("a", 0, 1, v) for v in range(20)]
    out, _ = run(
        spark,
        tmp_path,
        [rows[:9], rows[9:], [report("z", 9, 9, 0)]],
        lambda s: streams.stream_newest(s, schemas.ATTRIBUTION_EVENTS),
    )
    from playerlens.sinks.tables import dedup_partition

    batch = dedup_partition(spark.createDataFrame(rows, KEYED), schemas.ATTRIBUTION_EVENTS)
    assert out[2] == {("a", batch.first()["value"])}


def test_first_copies_expire(spark, tmp_path):
    parts = [
        [report("a", 0, 1, 1)],
        [report("a", 0, 2, 2), report("b", 1, 1, 3)],
        [report("c", 9, 9, 4)],
        [report("c", 9, 9, 5), report("d", 12, 9, 6)],
    ]
    out, progress = run(
        spark, tmp_path, parts, lambda s: streams.stream_dedup(s, schemas.ATTRIBUTION_EVENTS, "1 day")
    )
    assert out == [{("a", 1)}, {("b", 3)}, {("c", 4)}, {("d", 6)}]
    assert [p["stateOperators"][0]["numRowsTotal"] for p in progress] == [1, 2, 1, 1]


def closed(spark, rows):
    """Closed sessions of (player, start hour), as a micro-batch brings them."""
    first = "struct(start AS event_timestamp, 0L AS event_id, player AS user_id, 'ios' AS platform, 'X' AS geo_country) AS first"
    numbers = (
        "engagement_msec events_count unique_event_types max_level_in_session levels_started levels_completed "
        "levels_ended levels_retried scores_posted best_score"
    ).split()
    df = spark.createDataFrame([(p, DAY + timedelta(hours=h)) for p, h in rows], "player string, start timestamp")
    return df.selectExpr(
        "player AS user_pseudo_id",
        first,
        "start AS session_start",
        "start AS session_end",
        "to_date(start) AS session_date",
        "0D AS session_revenue",
        *[f"1L AS {c}" for c in numbers],
    )


def numbered(spark, target):
    rows = streams.read_numbered_sessions(spark, target)
    return {(r["user_pseudo_id"], r["session_start"]): r["session_id"] for r in rows.collect()}


def test_numbers_go_on_over_micro_batches_snapshots_and_retries(spark, tmp_path):
    target, counters = f"{tmp_path}/out", f"{tmp_path}/counters"
    load = streams._numberer(target, counters)
    batches = [[("a", 10 * b), ("a", 10 * b + 5), *([("b", 10 * b)] if b % 7 == 0 else [])] for b in range(36)]
    batches[3] = []
    for b, rows in enumerate(batches):
        for _ in range(2 if b in (0, 5, 15, 16, 31) else 1):  # once more after a failure
            load(closed(spark, rows), b)
    every = sorted(r for rows in batches for r in rows)
    starts = spark.createDataFrame([(p, DAY + timedelta(hours=h)) for p, h in every], "user_pseudo_id string, session_start timestamp")
    number = F.expr("row_number() OVER (PARTITION BY user_pseudo_id ORDER BY session_start)").cast("bigint")
    want = starts.withColumn("n", number).withColumn("id", staging.session_id(F.col("n")))
    assert numbered(spark, target) == {(r["user_pseudo_id"], r["session_start"]): r["id"] for r in want.collect()}
    # A retry reads nothing it wrote itself.
    snapshot = spark.read.parquet(f"{counters}/batch=31")
    assert {r["user_pseudo_id"]: r["sessions"] for r in snapshot.collect()} == {"a": 62, "b": 5}


def test_state_has_the_named_partitions_not_those_of_all_shuffles(spark, tmp_path):
    streams.keep_state_on_disk(spark)
    rows = spark.createDataFrame(
        [(f"p{k}", f"u{k}", DAY + timedelta(hours=k), "e", k) for k in range(40)],
        "user_pseudo_id string, user_id string, event_timestamp timestamp, event_name string, event_id bigint",
    ).selectExpr(
        "*",
        "to_date(event_timestamp) AS event_date",
        "'ios' AS platform",
        "'X' AS geo_country",
        "1L AS engagement_time_msec",
        "0D AS event_value_usd",
        "1L AS param_level",
        "1L AS param_score",
    )
    source, target, counters, state = (f"{tmp_path}/{x}" for x in ("in", "out", "counters", "state"))
    rows.write.parquet(source)
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "64")
    try:
        events = spark.readStream.schema(rows.schema).parquet(source)
        streams.stream_numbered_sessions(events, target, counters, state).awaitTermination()
        assert spark.conf.get(setting) == "64"
    finally:
        spark.conf.set(setting, before)
    kept = [p.name for p in (tmp_path / "state" / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(kept) == 32
    assert len(numbered(spark, target)) == 38  # the last two are open for the delay and the gap
