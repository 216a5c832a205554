"""Checks of loaded tables: summaries per layer, load reports, structure and schema drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLAYER = "user_pseudo_id"


def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _readings(summary: DataFrame, check: str) -> DataFrame:
    """One summary row as (check, metric, value, text) rows."""
    rows = []
    for f in summary.schema:
        c = F.col(f"`{f.name}`")
        is_text = isinstance(f.dataType, (T.StringType, T.DateType, T.TimestampType))
        rows.append(
            F.struct(
                F.lit(check).alias("check_name"),
                F.lit(f.name).alias("metric"),
                (F.lit(None) if is_text else c).cast("double").alias("value"),
                (c if is_text else F.lit(None)).cast("string").alias("text_value"),
            )
        )
    return summary.select(F.inline(F.array(*rows)))


def _rows_and_users(table: DataFrame, *more: Column) -> DataFrame:
    return table.agg(_count("rows"), F.countDistinct(PLAYER).alias("users"), *more)


def verify_layers(tables: dict[str, DataFrame]) -> DataFrame:
    """Twelve summaries over the layers, as far as their tables are given.

    Keys: raw_events, stg_events, stg_sessions, dim_users, fact_events, fact_sessions,
    fact_levels, mart_daily_kpis, mart_retention_cohorts, mart_player_segments,
    mart_level_funnel, feature_store.
    """

    def raw_events(t):
        combos = t.groupBy(PLAYER, "event_name").agg(
            _count("n"), F.min("event_date").alias("a"), F.max("event_date").alias("b")
        )
        return combos.agg(
            F.sum("n").alias("rows"),
            F.countDistinct(PLAYER).alias("users"),
            F.countDistinct("event_name").alias("events"),
            F.min("a").alias("start"),
            F.max("b").alias("end"),
        )

    def duration(name):
        return F.avg("session_duration_sec").alias(name)

    summaries = {
        "raw_events": raw_events,
        "stg_events": _rows_and_users,
        "stg_sessions": lambda t: _rows_and_users(t, duration("avg_duration")),
        "dim_users": lambda t: t.agg(
            _count("users"),
            F.count_if("is_payer").alias("payers"),
            F.avg("active_days").alias("avg_active_days"),
            F.avg("max_level").alias("avg_level"),
        ),
        "fact_events": lambda t: t.agg(_count("rows")),
        "fact_sessions": lambda t: t.agg(_count("rows"), duration("avg_dur")),
        "fact_levels": lambda t: t.agg(
            _count("rows"), F.countDistinct("level_number").alias("unique_levels")
        ),
        "mart_daily_kpis": lambda t: t.agg(
            _count("days"),
            F.avg("dau").alias("avg_dau"),
            F.avg("stickiness").alias("avg_stickiness"),
        ),
        "mart_retention_cohorts": lambda t: t.agg(
            _count("cohorts"),
            F.avg("d1_retention").alias("avg_d1"),
            F.avg("d7_retention").alias("avg_d7"),
        ),
        "mart_level_funnel": lambda t: t.agg(
            _count("levels"),
            F.min("completion_rate").alias("min_rate"),
            F.max("completion_rate").alias("max_rate"),
        ),
        "feature_store": lambda t: t.agg(
            _count("users"), F.avg("is_churned").alias("churn_rate")
        ),
    }
    parts = [
        _readings(summarise(tables[name]), name)
        for name, summarise in summaries.items()
        if name in tables
    ]
    if "mart_player_segments" in tables:
        # One row per segment instead of one per metric.
        parts.append(
            tables["mart_player_segments"]
            .groupBy("player_segment")
            .agg(_count("n"))
            .select(
                F.lit("mart_player_segments").alias("check_name"),
                F.concat(F.lit("count:"), "player_segment").alias("metric"),
                F.col("n").cast("double").alias("value"),
                F.lit(None).cast("string").alias("text_value"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


class LoadReport:
    """Counts what a write puts out while it runs, without reading the table again."""

    def __init__(self, table: str, time_column: str | None = None):
        self._table = table
        self._time_column = time_column
        self._seen = Observation(f"load of {table}")

    def watch(self, df: DataFrame) -> DataFrame:
        """``df`` to be written in place of the original. Works for one write."""
        metrics = [_count("rows_loaded")]
        if self._time_column:
            at = F.col(self._time_column)
            metrics += [
                F.min(at).cast("string").alias("date_from"),
                F.max(at).cast("string").alias("date_to"),
            ]
        return df.observe(self._seen, *metrics)

    def result(self) -> dict:
        """Available once the write has ended."""
        return {"destination": self._table, **self._seen.get}


def load_report(df: DataFrame, table: str, time_column: str) -> DataFrame:
    """The same numbers for a table that is already there."""
    at = F.col(time_column)
    return df.agg(
        F.lit(table).alias("destination"),
        _count("rows_loaded"),
        F.min(at).alias("date_from"),
        F.max(at).alias("date_to"),
    )


def table_structure(
    spark: SparkSession, tables: dict[str, DataFrame], layouts: dict[str, tuple[str, tuple]]
) -> DataFrame:
    """Columns, partition column, cluster columns and rows of each table.

    ``layouts`` maps a table to its partition column and cluster columns.
    """
    parts = []
    for name, df in tables.items():
        partition, cluster = layouts.get(name, (None, ()))
        parts.append(
            df.agg(
                F.lit(name).alias("table_name"),
                F.lit(len(df.columns)).alias("columns"),
                F.lit(partition).cast("string").alias("partition_column"),
                F.lit(", ".join(cluster)).alias("cluster_columns"),
                _count("rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def schema_diff(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns that differ: ``missing`` (expected only), ``unexpected`` or ``type_changed``."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    rows = [(c, "missing", t, None) for c, t in wanted.items() if c not in actual]
    rows += [(c, "unexpected", None, t) for c, t in actual.items() if c not in wanted]
    rows += [
        (c, "type_changed", t, actual[c])
        for c, t in wanted.items()
        if c in actual and actual[c] != t
    ]
    return df.sparkSession.createDataFrame(
        sorted(rows), "column STRING, status STRING, expected_type STRING, actual_type STRING"
    )
