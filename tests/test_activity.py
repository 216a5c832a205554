"""Activity bitmaps: loads in any order, dates on both sides of a span, what a load touches."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from playerlens.operators import activity, marts
from playerlens.sinks.tables import read_table

SCHEMA = "user_pseudo_id string, event_date date"


def days_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_retention_over_the_ends_of_spans(spark, tmp_path):
    start = date(1969, 11, 20)  # before and after the day that is counted from
    rows = [(f"p{p}", start + timedelta(days=p + n)) for p in range(90) for n in (0, 1, 7, 30, 64, 65) if (p + n) % 4]
    events = days_of(spark, rows * 2)
    users = spark.createDataFrame(
        [(f"p{p}", start + timedelta(days=p + shift), ("ios", None)[p % 2], "s") for p in range(90) for shift in (0, 3)],
        "user_pseudo_id string, install_date date, platform string, traffic_source string",
    )
    path = f"{tmp_path}/bitmaps"
    age = F.datediff("event_date", F.lit(start))
    activity.store_activity(path, events.filter(age % 3 == 0))
    for part in (age % 3 == 1, age % 3 == 2, age < 40, age < -1):
        activity.add_activity(spark, path, events.filter(part))
    got = activity.retention_cohorts(users, read_table(spark, path))
    want = marts.mart_retention_cohorts(users, events)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    players = {r["date"]: r["players"] for r in activity.daily_players(read_table(spark, path)).collect()}
    assert players == {d: len({p for p, e in rows if e == d}) for d in {e for _, e in rows}}


def test_a_load_rewrites_its_span_only(spark, tmp_path):
    path = f"{tmp_path}/bitmaps"
    first = date(2024, 1, 1)
    activity.store_activity(path, days_of(spark, [("a", first), ("b", first + timedelta(days=70)), ("a", first + timedelta(days=150))]))
    before = set(tmp_path.rglob("*.parquet"))
    assert activity.add_activity(spark, path, days_of(spark, [("c", first + timedelta(days=71))])) == 2
    after = set(tmp_path.rglob("*.parquet"))
    assert len(before - after) == 1 and len(before & after) == 2
    assert activity.add_activity(spark, path, days_of(spark, [])) == 0
    assert activity.add_activity(spark, path, days_of(spark, [(None, first), ("a", None)])) == 0
    assert read_table(spark, path).count() == 4
