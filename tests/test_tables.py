from datetime import date, datetime
from pathlib import Path
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from checks.queries import RUN, Inputs
from playerlens import schemas
from playerlens.operators import quality
from playerlens.plans import churn_job, daily, full_run, layers
from playerlens.session import prepare_for_tables, scratch_path
from playerlens.sinks import tables
from playerlens.sources import normalize, readers
from playerlens.streaming import streams

SF_DIR = "/root/testdata/sf0.001"


def test_canonical_names_and_clashes(spark):
    df = spark.createDataFrame([(1, 2)], "` Event-Time ` INT, `Media Source` INT")
    assert normalize.canonical_columns(df).columns == ["event_time", "media_source"]
    with pytest.raises(ValueError):
        normalize.canonical_columns(spark.createDataFrame([(1, 2)], "`a-b` INT, `A B` INT"))


def test_bad_values_become_null(spark):
    df = spark.createDataFrame(
        [("2024-01-02 03:04:05", "1.5"), ("soon", "free"), (None, None)],
        "event_time STRING, event_revenue STRING",
    )
    got = normalize.coerce_amounts(normalize.coerce_times(df)).collect()
    assert [tuple(r) for r in got] == [(datetime(2024, 1, 2, 3, 4, 5), 1.5)] + [(None, None)] * 2


def test_unknown_report_type(spark):
    with pytest.raises(ValueError):
        readers.select_report(spark.range(1), "clicks", date(2024, 1, 1), date(2024, 1, 1))


def test_empty_landing_and_empty_report(spark):
    root = scratch_path(spark, "landing")
    nothing = readers.read_landing(spark, root, "installs", date(2024, 1, 1))
    assert nothing.count() == 0 and "install_time" in nothing.columns
    path = scratch_path(spark, "report")
    spark.createDataFrame([], "value STRING").coalesce(1).write.text(path)
    assert readers.read_report_csv(spark, path, schemas.RAW_UNINSTALLS).count() == 0


def test_one_hour_of_the_landing_zone(spark):
    root = scratch_path(spark, "landing")
    rows = spark.range(6).select(
        F.col("id").cast("string").alias("appsflyer_id"), (F.col("id") % 3).alias("h")
    )
    rows.write.partitionBy("h").parquet(f"{root}/t=installs/dt=2024-01-01")
    hour = readers.read_landing(spark, root, "installs", date(2024, 1, 1), hour=2)
    assert sorted(r["appsflyer_id"] for r in hour.collect()) == ["2", "5"]


def test_update_changes_matched_rows_only(spark):
    target = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k STRING, v DOUBLE")
    source = spark.createDataFrame([("b", 9.0), ("c", 7.0)], "k STRING, n DOUBLE")
    got = tables.update_from(target, source, "k", {"v": F.col("src.n")}).collect()
    assert sorted(map(tuple, got)) == [("a", 1.0), ("b", 9.0)]
    twice = source.unionByName(source)
    with pytest.raises(Exception, match="several source rows"):
        tables.update_from(target, twice, "k", {"v": F.col("src.n")}).collect()


def test_overwriting_partitions_keeps_the_others(spark):
    path = scratch_path(spark, "days")
    rows = spark.range(10).select("id", (F.col("id") % 2).alias("d"))
    assert tables.write_table(rows, path, partition="d") == 10
    new = spark.range(3).select("id", F.lit(1).cast("bigint").alias("d"))
    assert tables.write_table(new, path, partition="d", only_partitions=True) == 3
    got = {r[0]: r[1] for r in tables.read_table(spark, path).groupBy("d").count().collect()}
    assert got == {0: 5, 1: 3}


def test_schema_diff(spark):
    df = spark.createDataFrame([], "event_time STRING, extra INT, platform STRING")
    got = {r["column"]: r["status"] for r in
           quality.schema_diff(df, schemas.RAW_UNINSTALLS).collect()}
    assert got["event_time"] == "type_changed" and got["extra"] == "unexpected"
    assert got["appsflyer_id"] == "missing" and "platform" not in got


def test_load_report_counts_during_the_write(spark):
    report = quality.LoadReport("somewhere", "d")
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 3),)], "d DATE")
    report.watch(df).write.parquet(scratch_path(spark, "observed"))
    assert report.result() == {
        "destination": "somewhere", "rows_loaded": 2, "date_from": "2024-01-01",
        "date_to": "2024-01-03",
    }


def test_layers_skip_what_depends_on_a_failure(spark):
    root = scratch_path(spark, "tables")
    raw = Inputs(spark, SF_DIR).raw.drop("event_key", "param_score")
    tables.write_table(raw, layers.stored_path(root, "raw_events"))
    report = layers.run_layers(spark, root, settings=RUN)
    assert report["stg_events"]["status"] == "error"
    assert report["stg_sessions"]["status"] == report["mart_geo_stats"]["status"] == "skipped"
    assert report["dim_dates"]["status"] == "success"
    with pytest.raises(ValueError):
        layers.run_layers(spark, root, "gold")


def test_tables_that_do_not_need_each_other_are_built_at_once(spark, monkeypatch):
    both = Barrier(2)

    def meets(spark, inputs, settings):
        both.wait(60)  # an error if the other table is not being built meanwhile
        return spark.range(3)

    plans = [layers.TablePlan(n, "marts", (), meets) for n in ("a", "b")]
    plans.append(layers.TablePlan("c", "marts", ("a", "b"), lambda spark, t, s: t["a"].unionAll(t["b"])))
    monkeypatch.setattr(layers, "TABLES", tuple(plans))
    monkeypatch.setattr(layers, "BY_NAME", {p.name: p for p in plans})
    report = layers.run_layers(spark, scratch_path(spark, "tables"), settings=RUN)
    assert {n: r.get("rows") for n, r in report.items()} == {"a": 3, "b": 3, "c": 6}


def test_dry_run_stores_nothing(spark):
    root = scratch_path(spark, "tables")
    tables.write_table(
        Inputs(spark, SF_DIR).raw.drop("event_key"), layers.stored_path(root, "raw_events")
    )
    report = layers.run_layers(spark, root, dry_run=True, settings=RUN)
    assert {r["status"] for r in report.values()} == {"dry_run"}
    assert "Aggregate" in report["mart_geo_stats"]["plan"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        layers.open_table(spark, root, "stg_events")


def test_full_run_stops_at_the_first_failure(spark):
    root = scratch_path(spark, "run")
    results = full_run.run(spark, f"{root}/nowhere", root, settings=RUN)
    assert list(results) == ["explore"] and results["explore"]["status"] == "error"
    with pytest.raises(ValueError):
        full_run.run(spark, root, root, ("deploy",))


def test_profiles_are_stored_side_by_side(spark, tmp_path, monkeypatch):
    source, root = str(tmp_path / "shards"), str(tmp_path / "run")
    tables.write_table(Inputs(spark, SF_DIR).nested, source, partition="suffix")
    together, write = Barrier(5, timeout=60), full_run.write_table

    def waiting(df, path, *rest):
        together.wait()
        return write(df, path, *rest)

    monkeypatch.setattr(full_run, "write_table", waiting)
    outcome = full_run.run(spark, source, root, ("explore",), settings=RUN)["explore"]
    assert outcome["status"] == "success", outcome
    for name, df in full_run.explore(spark, source, RUN).items():
        stored = tables.read_table(spark, tables.table_path(root, "raw", f"profile_{name}"))
        assert stored.count() == outcome["result"][name] > 0
        assert stored.exceptAll(df).isEmpty() and df.exceptAll(stored).isEmpty(), name


def test_the_summaries_of_a_run_are_stored(spark, tmp_path):
    root = str(tmp_path)
    tables.write_table(Inputs(spark, SF_DIR).raw, layers.stored_path(root, "raw_events"))
    found = full_run.run(spark, root, root, ("verify",), settings=RUN)["verify"]
    assert found["status"] == "success", found
    stored = tables.read_table(spark, full_run.summaries_path(root)).collect()
    assert sorted(stored) == sorted(found["result"])
    assert sorted(stored) == sorted(full_run.verify(spark, root).collect()) and len(stored) == 5


def test_players_are_segmented_beside_the_training(spark, tmp_path, monkeypatch):
    i, root = Inputs(spark, SF_DIR), str(tmp_path)
    for name, df in {
        "dim_users": i.users,
        "fact_sessions": i.sessions,
        "fact_events": i.events,
        "fact_revenue": i.revenue,
    }.items():
        tables.write_table(df, layers.stored_path(root, name))
    together = Barrier(2, timeout=60)
    train, metrics = churn_job.churn.train, churn_job.segments.user_metrics

    def waiting(step):
        def run(*args, **named):
            together.wait()
            return step(*args, **named)

        return run

    monkeypatch.setattr(churn_job.churn, "train", waiting(train))
    monkeypatch.setattr(churn_job.segments, "user_metrics", waiting(metrics))
    report = churn_job.churn_job(spark, root, "retrain", RUN, datetime(2024, 1, 30))
    assert sum(report["segments"].values()) == report["predictions"] > 0


def test_churn_job_modes(spark):
    with pytest.raises(ValueError):
        churn_job.churn_job(spark, "nowhere", "tune")
    assert churn_job.newest_model(spark, scratch_path(spark, "models")) is None


def test_csv_files_are_read_by_their_own_header(spark):
    root = scratch_path(spark, "landing")
    folder = f"{root}/t=installs/dt=2024-01-01"
    texts = {
        1: "appsflyer_id,media_source\na1,x\n",
        2: 'media_source,appsflyer_id\n"two\nlines",a2\n',
        3: "appsflyer_id,extra,media_source\na3,e,z\n",
    }
    for hour, text in texts.items():
        spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.option(
            "lineSep", "\n"
        ).text(f"{folder}/h={hour}")
    _rename(spark, folder, "csv")
    rows = readers.read_landing(spark, root, "installs", date(2024, 1, 1), multi_line=True)
    got = {r["appsflyer_id"]: (r["media_source"], r["extra"]) for r in rows.collect() if r["appsflyer_id"]}
    assert got == {"a1": ("x", None), "a2": ("two\nlines", None), "a3": ("z", "e")}


def _rename(spark, folder, suffix):
    for file in Path(folder.removeprefix("file:")).rglob("part-*"):
        file.rename(file.with_suffix(f".{suffix}"))


def test_loading_a_day_twice_keeps_one_row_for_each_key_on_every_day(spark):
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "raw")
    rows = spark.range(12).select(
        F.concat(F.lit("a"), "id").alias("appsflyer_id"),
        F.date_add(F.lit(date(2024, 1, 5)), -(F.col("id") % 3).cast("int"))
        .cast("timestamp")
        .alias("install_time"),
        F.when(F.col("id") < 11, "x").alias("media_source"),
    )
    rows.write.parquet(f"{landing}/t=installs/dt=2024-01-05/h=1")
    for hour in (1, 2):
        done = daily.daily_ingest(
            spark, landing, root, date(2024, 1, 5), loaded_at=datetime(2024, 1, 5, hour)
        )
        assert done["installs"]["rows"] == 12
    stored = tables.read_table(spark, tables.table_path(root, "raw", "raw_installs"))
    assert stored.count() == stored.select("appsflyer_id").distinct().count() == 12
    assert {r[0].hour for r in stored.select("_ingestion_timestamp").distinct().collect()} == {2}


def test_stream_and_batch_share_a_raw_table(spark):
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "raw")
    rows = spark.range(20).select(
        F.concat(F.lit("a"), "id").alias("appsflyer_id"),
        F.date_add(F.lit(date(2024, 1, 5)), -(F.col("id") % 4).cast("int"))
        .cast("timestamp")
        .alias("install_time"),
    )
    rows.write.parquet(f"{landing}/t=installs/dt=2024-01-05/h=1")
    shapes = {"installs": rows.schema}
    for running in streams.stream_landing(
        spark, landing, root, scratch_path(spark, "state"), parquet_schemas=shapes
    ):
        running.awaitTermination()
    path = tables.table_path(root, "raw", "raw_installs")
    assert tables.read_table(spark, path).count() == 20
    result = daily.daily_ingest(spark, landing, root, date(2024, 1, 5), keep_days=2)
    assert result["raw_installs"]["rows"] == 20
    assert result["raw_installs"]["expired"] == ["2024-01-02"]
    left = tables.read_table(spark, path)
    assert left.count() == left.select("appsflyer_id").distinct().count() == 15


def test_a_repeated_micro_batch_leaves_no_second_copy(spark):
    root = scratch_path(spark, "raw")
    table = schemas.INSTALLS
    load = streams._loader(root, "installs-parquet", table, streams.Lock())
    rows = spark.range(6).select(
        F.concat(F.lit("a"), "id").alias("appsflyer_id"),
        F.lit(datetime(2024, 1, 5)).alias("install_time"),
        F.lit("x/t=installs/dt=2024-01-05/h=1/f").alias("_path"),
    )
    for batch in (0, 1, 1):
        load(rows, batch)
    stored = tables.read_table(spark, tables.table_path(root, "raw", table.name))
    assert stored.count() == 12


def test_the_fixture_leaves_no_event_out(spark):
    raw = Inputs(spark, SF_DIR).raw
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    assert raw.select("event_key").distinct().count() == events.count()


def test_stored_tables_can_be_read_by_name(spark):
    root = scratch_path(spark, "tables")
    tables.write_table(
        Inputs(spark, SF_DIR).raw.drop("event_key"), layers.stored_path(root, "raw_events")
    )
    for _ in range(2):
        report = layers.run_layers(spark, root, "staging", settings=RUN, register="named")
    rows = {name: r["rows"] for name, r in report.items()}
    assert rows and all(spark.table(f"named_staging.{n}").count() == c for n, c in rows.items())
    for layer in tables.LAYERS:
        spark.sql(f"DROP SCHEMA named_{layer} CASCADE")


def test_schema_is_kept_beside_the_rows(spark, tmp_path):
    path = f"{tmp_path}/table"
    one = spark.createDataFrame([(1, "2024-01-01")], "a int, d string")
    tables.append_table(one, path, "d")
    tables.append_table(one.withColumn("b", F.lit(2.5)), path, "d")
    tables.append_table(one, path, "d")
    stored = tables.read_table(spark, path)
    assert stored.columns == ["a", "b", "d"]
    assert sorted(str(r["b"]) for r in stored.collect()) == ["2.5", "None", "None"]
    with pytest.raises(ValueError, match="column a is int in the table, bigint in the load"):
        tables.append_table(one.withColumn("a", F.lit(1).cast("bigint")), path, "d")
    empty = f"{tmp_path}/empty"
    tables.write_table(one.limit(0), empty, partition="d")
    assert tables.read_table(spark, empty).schema == tables.read_table(spark, path).drop("b").schema
    assert tables.read_table(spark, empty).count() == 0
    # An overwrite starts anew; another folder is read as it is.
    tables.write_table(one.select("a"), path)
    assert tables.read_table(spark, path).columns == ["a"]
    one.write.parquet(f"{tmp_path}/plain")
    assert tables.read_table(spark, f"{tmp_path}/plain").count() == 1


def test_a_failing_rewrite_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/users"
    tables.write_table(spark.range(3), path)
    read = lambda: sorted(r["id"] for r in tables.read_table(spark, path).collect())
    bad = F.when(F.col("id") == 1, F.raise_error(F.lit("stop"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="stop"):
        tables.rewrite_table(tables.read_table(spark, path).withColumn("id", bad.cast("bigint")), path)
    assert read() == [0, 1, 2]
    for _ in range(3):  # each is computed from the version before
        stored = tables.read_table(spark, path)
        assert tables.rewrite_table(stored.withColumn("id", F.col("id") + 1), path) == 3
    assert read() == [3, 4, 5]
    with pytest.raises(Exception, match="stop"):
        tables.rewrite_table(spark.range(2).withColumn("id", bad.cast("bigint")), path)
    assert read() == [3, 4, 5]
    with pytest.raises(ValueError, match="cannot be added to"):
        tables.append_table(spark.range(1), path)
    tables.create_layers(spark, "versions")
    name = tables.register_table(spark, path, "warehouse", "users", "versions")
    assert sorted(r["id"] for r in spark.table(name).collect()) == [3, 4, 5]
    assert tables.drop_versions(spark, path) == 1 and tables.drop_versions(spark, path) == 0
    assert read() == [3, 4, 5]
    tables.write_table(spark.range(1), path)
    assert read() == [0]


def test_retrain_and_predict_over_stored_tables(spark, tmp_path):
    """Predictions and segments reach the dimension in one version each run."""
    i, root = Inputs(spark, "/root/testdata/sf0.001"), str(tmp_path)
    for name, df in {
        "dim_users": i.users,
        "fact_sessions": i.sessions,
        "fact_events": i.events,
        "fact_revenue": i.revenue,
    }.items():
        tables.write_table(df, layers.stored_path(root, name))
    modes = [churn_job.churn_job(spark, root, m, RUN, datetime(2024, 1, 30, h))["mode"] for h, m in ((1, "retrain"), (2, "predict"))]
    assert modes == ["retrain", "predict"]
    path = layers.stored_path(root, "dim_users")
    assert len(tables._versions(spark, path)) == 2
    users = tables.read_table(spark, path)
    scored = tables.read_table(spark, churn_job.ml_path(root, "predictions")).select("user_pseudo_id").distinct()
    with_risk = users.filter("churn_probability IS NOT NULL").select("user_pseudo_id").distinct()
    assert scored.exceptAll(with_risk).isEmpty() and with_risk.exceptAll(scored).isEmpty()
    assert users.filter("player_segment IS NOT NULL").count() > 0


def test_rows_of_a_day_are_not_brought_to_one_task(spark, tmp_path, monkeypatch):
    """Days of a load are found without a shuffle by day, and rows without a day are among them."""
    table, path = schemas.RAW_TABLES["raw_attribution_events"], f"{tmp_path}/t"
    rows = spark.range(2000).select(
        F.concat(F.lit("d"), F.col("id") % 500).alias("appsflyer_id"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.lit("2024-01-08 10:00:00")).cast("timestamp").alias("event_time"),
        *[F.lit("e").alias(c) for c in ("event_name", "platform", "country_code")],
        F.timestamp_seconds("id").alias("_ingestion_timestamp"),
    )
    other = rows.withColumn("event_time", F.lit("2024-01-07 10:00:00").cast("timestamp"))
    tables.load_raw(rows.unionByName(other), path, table)
    plans, dedup = [], tables.dedup_partition

    def watched(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return dedup(df, *more)

    monkeypatch.setattr(tables, "dedup_partition", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = tables.dedup_stored(spark, path, table, tables.days_of(rows, table))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kept == 500 and "Exchange" not in plans[0]
    assert tables.read_table(spark, path).count() == 500 + 2000


def test_a_hot_day_is_sorted_in_small_parts(spark):
    """30 MB as shuffled, all on one day: over several tasks and files, no row lost."""
    path = scratch_path(prepare_for_tables(spark), "hot")
    rows = spark.range(0, 2_000_000, 1, 8).select(
        F.lit(date(2024, 1, 8)).alias(tables.DAY), F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b")
    )
    assert tables.write_table(rows, path, partition=tables.DAY, cluster=("a",)) == 2_000_000
    stored = tables.read_table(spark, path)
    assert stored.select(F.input_file_name()).distinct().count() > 1
    assert stored.exceptAll(rows.select(*stored.columns)).isEmpty()
