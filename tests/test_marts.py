from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import REF, Inputs
from playerlens.operators import dashboards, evaluation, features, funnel, marts, ranking, warehouse
from playerlens.session import cut_lineage
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def inputs(spark):
    built = Inputs(spark, SF_DIR)
    built.events = built.events.cache()
    built.sessions = built.sessions.cache()
    built.users = built.users.cache()
    yield built
    for df in (built.events, built.sessions, built.users):
        df.unpersist()


@pytest.mark.parametrize("days", [1, 3, 30])
def test_rolling_active_equals_range_join(inputs, days):
    seen = inputs.events.select("event_date", "platform", "user_pseudo_id").distinct()
    dates = seen.select(F.col("event_date").alias("date"), F.col("platform").alias("on")).distinct()
    joined = (
        dates.join(
            seen,
            (F.col("on") == F.col("platform"))
            & F.col("event_date").between(F.date_sub("date", days - 1), F.col("date")),
        )
        .groupBy("date", "platform")
        .agg(F.countDistinct("user_pseudo_id").alias("mau"))
    )
    ours = marts.rolling_active(inputs.events, days)
    assert ours.exceptAll(joined.select("date", "platform", "mau")).count() == 0
    assert ours.count() == joined.count()


def test_retention_equals_conditional_distinct(inputs):
    active = inputs.events.select("user_pseudo_id", "event_date").distinct()
    back = inputs.users.select(
        "user_pseudo_id", F.col("install_date").alias("cohort_date"), "platform", "traffic_source"
    ).join(active, "user_pseudo_id")
    age = F.datediff("event_date", "cohort_date")
    wanted = back.groupBy("cohort_date", "platform", "traffic_source").agg(
        *[
            F.countDistinct(F.when(age == n, F.col("user_pseudo_id"))).alias(name)
            for n, name in ((0, "cohort_size"), (1, "d1_users"), (7, "d7_users"))
        ]
    )
    ours = marts.mart_retention_cohorts(inputs.users, inputs.events).select(*wanted.columns)
    assert ours.exceptAll(wanted).count() == 0


def test_invariants(inputs):
    assert inputs.sessions.agg(F.sum("events_count")).first()[0] == inputs.events.count()
    kpis = marts.mart_daily_kpis(inputs.events, inputs.sessions, inputs.users)
    assert kpis.filter("dau > mau OR stickiness > 1 OR stickiness <= 0").count() == 0
    assert kpis.agg(F.sum("total_sessions")).first()[0] == inputs.sessions.count()
    cohorts = marts.mart_retention_cohorts(inputs.users, inputs.events)
    bad = " OR ".join(f"d{n}_retention NOT BETWEEN 0 AND 1" for n in (1, 3, 7, 14, 30))
    assert cohorts.filter(bad).count() == 0
    assert cohorts.agg(F.sum("cohort_size")).first()[0] == inputs.users.count()


def test_session_buckets_share_300_seconds(spark):
    rows = [(date(2024, 1, 1), "ios", f"p{s}", s, 1.0, 1, 0, 0.0)
            for s in (59, 60, 300, 900, 901)]
    sessions = spark.createDataFrame(
        rows,
        "session_date DATE, platform STRING, user_pseudo_id STRING, session_duration_sec BIGINT, "
        "total_engagement_sec DOUBLE, events_count BIGINT, levels_completed BIGINT, "
        "session_revenue DOUBLE",
    )
    got = marts.mart_session_stats(sessions).first()
    counts = [got[c] for c in ("sessions_under_1min", "sessions_1_5min", "sessions_5_15min",
                               "sessions_over_15min")]
    assert counts == [1, 2, 2, 1] and got["median_duration_sec"] == 300


def test_quantiles_of_very_many_rows_are_exact(spark):
    """A million different lengths and scores, in no order."""
    n = 1_000_000
    value = (F.col("id") * 736_481) % n
    sessions = spark.range(n, numPartitions=16).select(
        F.lit(date(2024, 1, 1)).alias("session_date"), F.lit("ios").alias("platform"), F.lit("p").alias("user_pseudo_id"),
        value.alias("session_duration_sec"), F.lit(1.0).alias("total_engagement_sec"), F.lit(1).alias("events_count"),
        F.lit(0).alias("levels_completed"), F.lit(0.0).alias("session_revenue"),
    )
    assert marts.mart_session_stats(sessions).first()["median_duration_sec"] == n // 2 - 1
    scores = sessions.selectExpr("'post_score' AS event_name", "1L AS level_number", "session_duration_sec AS score", "user_pseudo_id")
    row = dashboards.score_distribution(scores).first()
    assert [row[c] for c in ("q25_score", "median_score", "q75_score")] == [n // 4 - 1, n // 2 - 1, 3 * n // 4 - 1]


def test_quantiles_without_values_and_at_whole_shares(spark):
    counts = spark.createDataFrame(
        [("a", v, 1) for v in range(1, 21)] + [("b", None, 5), (None, 7, 2)], "k string, v bigint, n bigint"
    )
    made = ranking.observed_quantiles(counts, ["k"], "v", "n", {"q": 0.95, "low": 0.05})
    assert {r["k"]: (r["q"], r["low"]) for r in made.collect()} == {"a": (19, 1), None: (7, 7)}


def test_churn_label_edge(spark):
    sessions = spark.createDataFrame(
        [("on_edge", date(2024, 1, 23)), ("before", date(2024, 1, 22))],
        "user_pseudo_id STRING, session_date DATE",
    )
    labels = {r[0]: r[1] for r in features.churn_labels(sessions, REF).collect()}
    assert labels == {"on_edge": 0, "before": 1}


def test_feature_columns_are_all_there(inputs):
    store = features.feature_store(
        inputs.users, inputs.sessions, inputs.events, inputs.revenue, REF,
        computed_at=datetime(2024, 1, 30),
    )
    assert set(features.FEATURE_COLUMNS) < set(store.columns)
    assert len(features.FEATURE_COLUMNS) == 39
    assert len(store.columns) == 7 + 38 + 2


def level_rows(spark, rates):
    return spark.createDataFrame(
        [(n, int(r * 100), 100, r, 5.0, 50.0, float(n)) for n, r in enumerate(rates, 1)],
        "level_number BIGINT, users_completed BIGINT, total_users BIGINT, "
        "completion_rate DOUBLE, avg_attempts DOUBLE, avg_best_score DOUBLE, "
        "avg_days_to_complete DOUBLE",
    )


def test_funnel_severity_modes(spark):
    levels = level_rows(spark, [0.9, 0.85, 0.80, 0.5])
    relative = funnel.level_funnel_enriched(levels).collect()
    assert [r["severity"] for r in relative] == ["normal", "normal", "normal", "severe"]
    assert relative[0]["drop_rate"] == 0 and relative[0]["prev_completion_rate"] is None
    absolute = funnel.level_funnel_enriched(levels, "absolute").collect()
    assert [r["severity"] for r in absolute] == ["severe", "warning", "warning", "severe"]
    with pytest.raises(ValueError):
        funnel.level_funnel_enriched(levels, "other")


def test_flat_funnel_has_no_average_drop(spark):
    got = funnel.level_funnel_enriched(level_rows(spark, [0.5, 0.5])).collect()
    assert {r["drop_vs_avg"] for r in got} == {None}
    assert {r["severity"] for r in got} == {"normal"}


def test_auc_equals_spark_evaluator(spark):
    df = spark.range(500).select(
        (F.pmod(F.xxhash64("id"), F.lit(1000003)) / 1000003.0).alias("p"),
        (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(3)) == 0).cast("int").alias("label"),
    )
    ours = evaluation.auc(df, "label", "p").first()[0]
    judge = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0)
    theirs = judge.evaluate(
        df.withColumn("raw", array_to_vector(F.array(1 - F.col("p"), F.col("p"))))
    )
    assert ours == pytest.approx(theirs, abs=1e-6)


def test_metrics_of_a_single_class(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label INT, p DOUBLE")
    got = evaluation.binary_metrics(df, "label", "p").first()
    assert got["auc_roc"] is None and got["precision"] == 0 and got["accuracy"] == 1
    gates = evaluation.passes_gates(evaluation.binary_metrics(df, "label", "p")).first()
    assert gates["passed"] is False


def test_events_are_scanned_at_most_twice(spark):
    built = Inputs(spark, "/root/testdata/sf0.001")
    events, sessions, users = map(cut_lineage, (built.events, built.sessions, built.users))
    for df, most in (
        (warehouse.dim_users(events, REF), 2),
        (marts.mart_daily_kpis(events, sessions, users), 3),
    ):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert 0 < plan.count("FileScan") <= most
