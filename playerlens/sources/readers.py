"""Readers for event shards, report files and the landing zone."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playerlens import schemas
from playerlens.settings import ATTRIBUTION_GAME_EVENTS, REPORT_TYPES
from playerlens.sources.normalize import canonical_columns


def read_event_shards(
    spark: SparkSession,
    path: str,
    date_from: date | None = None,
    date_to: date | None = None,
) -> DataFrame:
    """Nested events of daily shards ``suffix=YYYYMMDD/``, both ends included.

    The range is on the partition column, so other shards are not listed into the scan.
    """
    schema = T.StructType([*schemas.NESTED_EVENTS.fields, T.StructField("suffix", T.StringType())])
    shards = spark.read.schema(schema).parquet(path)
    if date_from is not None:
        shards = shards.filter(F.col("suffix") >= date_from.strftime("%Y%m%d"))
    if date_to is not None:
        shards = shards.filter(F.col("suffix") <= date_to.strftime("%Y%m%d"))
    return shards


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _csv(spark: SparkSession, path: str, multi_line: bool, **options) -> DataFrame | None:
    """CSV files, each read by its own header line; None when no file has one.

    The files of one header are read together, and the parts are joined by column name. What
    reaches the driver is one row per file.
    """
    lines = spark.read.options(**options).text(path)
    first = (
        lines.filter(F.col("_metadata.file_block_start") == 0)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("n"),
            "value",
        )
        .groupBy("file")
        .agg(F.min_by("value", "n").alias("header"))
    )
    by_header: dict[str, list[str]] = {}
    for row in first.orderBy("file").collect():
        by_header.setdefault(row["header"], []).append(unquote(row["file"]))
    reader = spark.read.options(
        header=True, enforceSchema=False, mode="PERMISSIVE", multiLine=multi_line, **options
    )
    parts = [canonical_columns(reader.csv(files)) for files in by_header.values()]
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_report_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """A report with a header line, as text columns under canonical names; empty without a body.

    ``multi_line`` allows line breaks inside quotes, and gives up splitting a file over tasks.
    """
    report = _csv(spark, path, multi_line)
    return _empty(spark, schema) if report is None else report


def read_landing(
    spark: SparkSession,
    root: str,
    report_type: str,
    day: date,
    hour: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Parquet and CSV files of ``t={type}/dt={date}/h={hour}/`` as one table.

    Only the directory asked for is listed. CSV files may differ in their columns; these are text
    until they are normalised, and where a column comes in both forms, it is text. No files give an
    empty table. ``multi_line`` is as in ``read_report_csv``.
    """
    path = f"{root}/t={report_type}/dt={day.isoformat()}"
    if hour is not None:
        path += f"/h={hour}"
    schema = schemas.REPORT_TARGETS[_checked_type(report_type)].schema
    found = []
    readers = (
        ("*.parquet", lambda: spark.read.options(mergeSchema=True, basePath=root,
                                                 pathGlobFilter="*.parquet").parquet(path)),
        ("*.csv", lambda: _csv(spark, path, multi_line, basePath=root, pathGlobFilter="*.csv")),
    )
    for _, read in readers:
        try:
            part = read()
        except AnalysisException as problem:
            if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                continue
            raise
        part = None if part is None else part.drop("t", "dt", "h")
        if part is not None and part.columns:
            found.append(canonical_columns(part))
    if not found:
        return _empty(spark, schema)
    if len(found) == 1:
        return found[0]
    parquet, csv = found
    shared = [c for c in parquet.columns if c in csv.columns]
    parquet = parquet.withColumns({c: F.col(c).cast("string") for c in shared})
    return parquet.unionByName(csv, allowMissingColumns=True)


# Report selection ---------------------------------------------------------------------------


def _checked_type(report_type: str) -> str:
    if report_type not in REPORT_TYPES:
        raise ValueError(f"unknown report type {report_type!r}; one of {', '.join(REPORT_TYPES)}")
    return report_type


def select_report(
    df: DataFrame,
    report_type: str,
    date_from: date,
    date_to: date,
    media_source: str | None = None,
    event_names: Sequence[str] | str | None = None,
    time_column: str = "event_time",
) -> DataFrame:
    """Rows of one report type and date range, both ends included.

    The range is on the bare time column, so it reaches the scan. ``event_names`` is a list or a
    comma-separated text.
    """
    at = F.col(time_column)
    rows = df.filter(
        (F.col("report_type") == _checked_type(report_type))
        & (at >= F.lit(date_from).cast("timestamp"))
        & (at < F.date_add(F.lit(date_to), 1).cast("timestamp"))
    )
    if media_source:
        rows = rows.filter(F.col("media_source") == media_source)
    if event_names:
        names = event_names.split(",") if isinstance(event_names, str) else list(event_names)
        rows = rows.filter(F.col("event_name").isin(*names))
    return rows


def select_daily_report(
    df: DataFrame, report_type: str, day: date | None = None, time_column: str = "event_time"
) -> DataFrame:
    """One day of a report, yesterday by default."""
    if day is not None:
        return select_report(df, report_type, day, day, time_column=time_column)
    yesterday = df.sparkSession.sql("SELECT date_sub(current_date(), 1)").first()[0]
    return select_report(df, report_type, yesterday, yesterday, time_column=time_column)


def select_game_events(
    df: DataFrame,
    date_from: date,
    date_to: date,
    events: Sequence[str] = ATTRIBUTION_GAME_EVENTS,
) -> DataFrame:
    return select_report(df, "in_app_events", date_from, date_to, event_names=events)


# Routing ------------------------------------------------------------------------------------


def path_parts(path: Column) -> dict[str, Column]:
    """Report type and date of a landing path; NULL where the path has none."""

    def part(pattern: str) -> Column:
        text = F.regexp_extract(path, pattern, 1)
        return F.when(text != "", text)

    return {
        "report_type": part(r"(?:^|/)t=([^/]+)"),
        "report_date": part(r"(?:^|/)dt=([^/]+)"),
    }


def target_table(report_type: Column) -> Column:
    target = F.lit(None).cast("string")
    for kind, table in schemas.REPORT_TARGETS.items():
        target = F.when(report_type == kind, table.name).otherwise(target)
    return target


def route_by_path(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Adds report type, date and target table by file path; rows that cannot be routed drop out.

    The path defaults to that of the file a row was read from.
    """
    parts = path_parts(F.col("_metadata.file_path") if path is None else path)
    routed = df.withColumns(parts).withColumn("target_table", target_table(F.col("report_type")))
    return routed.filter(F.col("target_table").isNotNull() & F.col("report_date").isNotNull())
