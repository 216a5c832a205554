"""Bucketed tables: plans without a shuffle, replaced days, writes that fail, features as from the facts."""

from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.present import shown
from checks.queries import RUN
from playerlens.operators import features, staging, warehouse
from playerlens.plans import incremental, layers, player_tables
from playerlens.sinks import buckets, tables
from tests.test_incremental import BASE, LATE, first, on, stored

AT = datetime(2024, 3, 9)
MARCH = RUN.__class__(**{**RUN.__dict__, "ref_date": date(2024, 3, 8)})


def rows_of(df):
    return Counter(map(str, shown(df).collect()))


def from_facts(spark, root):
    opened = [layers.open_table(spark, root, n) for n in ("dim_users", "fact_sessions", "fact_events", "fact_revenue")]
    return features.feature_store(*opened, MARCH.ref_date, computed_at=AT)


def test_features_follow_loads_without_a_shuffle(spark, tmp_path):
    root = f"{tmp_path}/t"
    paid = [on("a", 70, event_value_in_usd=3.5, event_name="in_app_purchase"), on("c", 2 * 86_400, event_name="ad_click", event_value_in_usd=0.25)]
    stored(spark, root, BASE + paid)
    layers.run_layers(spark, root, settings=MARCH)
    names = player_tables.build(spark, root, "bucket_test", buckets=3)
    made = player_tables.player_features(spark, MARCH, AT, "bucket_test")
    assert rows_of(made) == rows_of(from_facts(spark, root))
    stored(spark, root, BASE + paid + LATE)
    incremental.update_layers(spark, root, [first(d) for d in (1, 2, 4, 7)], MARCH, "bucket_test")
    made = player_tables.player_features(spark, MARCH, AT, "bucket_test")
    assert rows_of(made) == rows_of(from_facts(spark, root)) and made.count() == 5
    # Without broadcasts, so that the plan is the one for large tables.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = player_tables.player_features(spark, MARCH, AT, "bucket_test")._jdf.queryExecution().toString()
        plain = from_facts(spark, root)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Exchange hashpartitioning" in plain
    assert {buckets.details(spark, n)["Num Buckets"] for n in names.values()} == {"3"}


def test_a_hot_player_has_few_rows_a_day(spark):
    """Reduced before they are bucketed: the rows of a player and day are those of the event names."""
    events = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("user_pseudo_id"),
        F.lit(date(2024, 3, 1)).alias("event_date"),
        F.when(F.col("id") % 2 == 0, "level_end").alias("event_name"),
        F.lit("true").alias("param_success"),
        F.col("id").alias("param_level"),
        F.lit(None).cast("bigint").alias("param_score"),
        F.lit(1).cast("bigint").alias("engagement_time_msec"),
    )
    days = features.engagement_days(events)
    assert days.filter("user_pseudo_id = 'hot'").count() == 2
    got = features.engagement_from_days(days, date(2024, 3, 2))
    want = features.engagement_features(events, date(2024, 3, 2))
    assert got.schema.names == want.schema.names and rows_of(got) == rows_of(want)


def test_no_rows(spark):
    events = staging.stg_events(_empty_raw(spark))
    revenue = warehouse.fact_revenue(events)
    ref = date(2024, 3, 2)
    assert features.engagement_from_days(features.engagement_days(events), ref).count() == 0
    assert features.monetary_from_days(features.revenue_days(revenue), ref).count() == 0


def _empty_raw(spark):
    from tests.test_staging import raw_rows

    return raw_rows(spark, BASE).filter("1 = 0")


def test_replaced_days(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS bucket_days")
    name, path = "bucket_days.t", f"{tmp_path}/t"
    rows = [("a", 1, first(1)), ("b", 2, first(1)), ("a", 3, first(2)), ("c", 4, first(3)), (None, 5, first(3))]
    schema = "player string, n int, day date"
    buckets.write_bucketed(spark.createDataFrame(rows, schema), name, path, "player", 2, "day")
    new = spark.createDataFrame([(6, "d", first(1))], "n int, player string, day date")
    untouched = {str(f) for f in Path(path).rglob("day=2024-03-03/*.parquet")}
    buckets.replace_bucketed_days(new, name, [first(1), first(2)])
    assert sorted(map(tuple, spark.table(name).collect()), key=str) == sorted(
        [("d", 6, first(1)), *rows[3:]], key=str
    )
    assert untouched == {str(f) for f in Path(path).rglob("day=2024-03-03/*.parquet")}
    with pytest.raises(ValueError, match="other days"):
        buckets.replace_bucketed_days(new, name, [first(2)])


def test_a_write_that_fails_leaves_the_table(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS bucket_fails")
    name, path = "bucket_fails.t", f"{tmp_path}/t"
    for n in (1, 2, 3):  # replaced while it is read
        rows = spark.range(n) if n == 1 else spark.table(name).unionByName(spark.range(1))
        buckets.write_bucketed(rows, name, path, "id", 2)
    assert spark.table(name).count() == 3
    assert len(list(Path(path).glob("_data-*"))) == 2
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        buckets.write_bucketed(bad, name, path, "id", 2)
    assert spark.table(name).count() == 3


def test_bucket_count(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_table(spark.range(1000), path)
    assert buckets.bucket_count(spark, [path]) == 1
    size = sum(f.stat().st_size for f in Path(path).rglob("*") if f.is_file())
    assert buckets.bucket_count(spark, [path], size // 5) in (8, 16)


def test_feature_store_bucketed_stores_each_fact_once(spark, monkeypatch):
    from checks import queries
    from playerlens.sinks import tables

    written, write = {}, tables.write_table

    def counted(df, path, *rest, **named):
        rows = write(df, path, *rest, **named)
        name = path.rpartition("/")[2]
        written[name] = written.get(name, 0) + rows
        return rows

    monkeypatch.setattr(tables, "write_table", counted)
    inputs = queries.Inputs(spark, "/root/testdata/sf0.001")
    made = queries.feature_store_bucketed(inputs)
    assert written["fact_events"] == inputs.events.count()
    assert written["fact_sessions"] == inputs.sessions.count()
    assert made.count() == written["dim_users"] == inputs.users.count()
