"""Projection stage of ingest: names, types, load columns, nested fields."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playerlens.functions.columns import event_param

# Report columns that hold times and amounts.
TIME_COLUMNS = ("event_time", "install_time", "attributed_touch_time")
AMOUNT_COLUMNS = ("event_revenue", "cost_value")


def canonical_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def canonical_columns(df: DataFrame) -> DataFrame:
    """Trimmed lower-case names with underscores; two names that become one are an error."""
    names = [canonical_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns with the same canonical name: {', '.join(clashes)}")
    return df.toDF(*names)


def coerce_times(df: DataFrame, columns: Sequence[str] = TIME_COLUMNS) -> DataFrame:
    """Parses text columns as UTC times; what is no time becomes NULL."""
    kinds = {f.name: f.dataType for f in df.schema}

    def parsed(c: str) -> Column:
        if isinstance(kinds[c], T.StringType):
            return F.try_to_timestamp(F.trim(c))
        return F.col(c).cast("timestamp")

    return df.withColumns({c: parsed(c) for c in columns if c in kinds})


def coerce_amounts(df: DataFrame, columns: Sequence[str] = AMOUNT_COLUMNS) -> DataFrame:
    """Parses columns as numbers; what is no number becomes NULL."""
    return df.withColumns(
        {c: F.col(c).try_cast("double") for c in columns if c in df.columns}
    )


def add_load_columns(df: DataFrame, source: str, loaded_at: datetime | None = None) -> DataFrame:
    stamp = F.lit(loaded_at) if loaded_at is not None else F.current_timestamp()
    return df.withColumns(
        {"_ingestion_timestamp": stamp.cast("timestamp"), "_source": F.lit(source)}
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order, absent ones NULL, unreadable values NULL; then any others."""
    known = {f.name for f in schema}

    def typed(field: T.StructField) -> Column:
        if field.name in df.columns:
            return F.col(field.name).try_cast(field.dataType).alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    return df.select(*[typed(f) for f in schema], *[F.col(f"`{c}`") for c in df.columns if c not in known])


def normalise_report(
    df: DataFrame, schema: T.StructType, source: str, loaded_at: datetime | None = None
) -> DataFrame:
    """A report as read from a file, in the form of its raw table."""
    typed = coerce_amounts(coerce_times(canonical_columns(df)))
    return conform(add_load_columns(typed, source, loaded_at), schema)


def flatten_events(nested: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Nested analytics events to the 34 flat columns.

    Parameters are looked up inside the array of each row, so nothing is exploded or shuffled. The
    session id is taken from the text slot or, where it is stored as a number, from that one.
    """
    stamp = F.lit(loaded_at) if loaded_at is not None else F.current_timestamp()

    def param(key: str, slot: str) -> Column:
        return event_param(key, slot).alias(f"param_{key}")

    session = F.coalesce(
        event_param("ga_session_id", "string_value"),
        event_param("ga_session_id", "int_value").cast("string"),
    )
    return nested.select(
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_timestamp"),
        "event_name",
        "event_value_in_usd",
        "user_pseudo_id",
        "user_id",
        F.timestamp_micros("user_first_touch_timestamp").alias("user_first_touch_timestamp"),
        "platform",
        "stream_id",
        F.col("device.category").alias("device_category"),
        F.col("device.mobile_brand_name").alias("device_brand"),
        F.col("device.mobile_model_name").alias("device_model"),
        F.col("device.operating_system").alias("device_os"),
        F.col("device.operating_system_version").alias("device_os_version"),
        F.col("device.language").alias("device_language"),
        F.col("geo.continent").alias("geo_continent"),
        F.col("geo.country").alias("geo_country"),
        F.col("geo.region").alias("geo_region"),
        F.col("geo.city").alias("geo_city"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.name").alias("traffic_campaign"),
        param("level", "int_value"),
        param("score", "int_value"),
        param("board", "string_value"),
        param("success", "string_value"),
        param("value", "double_value"),
        param("virtual_currency_name", "string_value"),
        param("engagement_time_msec", "int_value"),
        param("firebase_screen", "string_value"),
        param("firebase_screen_class", "string_value"),
        session.alias("param_session_id"),
        stamp.cast("timestamp").alias("_ingestion_timestamp"),
        F.col("suffix").alias("_source_date_suffix"),
    )


def repeated_params(nested: DataFrame) -> DataFrame:
    """Events per parameter key that occurs more than once in the same event."""
    keys = F.col("event_params.key")
    repeated = F.array_distinct(
        F.filter(keys, lambda k: F.size(F.filter(keys, lambda other: other == k)) > 1)
    )
    return (
        nested.select(F.explode(repeated).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("events"))
    )
