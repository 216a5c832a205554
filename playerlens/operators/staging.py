"""Raw events to clean events and sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playerlens.functions.columns import stable_id

PLAYER = "user_pseudo_id"

# Later copies first; the rest only makes the choice repeatable when one load stamps all rows alike.
EVENT_ORDER = (
    "_ingestion_timestamp",
    "param_level",
    "param_score",
    "param_success",
    "param_engagement_time_msec",
    "event_value_in_usd",
)


def with_player_and_time(raw: DataFrame) -> DataFrame:
    """Events that name a player and a time."""
    return raw.filter(F.col(PLAYER).isNotNull() & F.col("event_timestamp").isNotNull())


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    A ``row_number() = 1`` filter: Spark trims every map task to one row per key before the
    shuffle (WindowGroupLimit), so a key with very many copies does not fill one task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def dedup_events(raw: DataFrame) -> DataFrame:
    keys = (PLAYER, "event_timestamp", "event_name")
    return dedup_latest(raw, keys, [F.desc_nulls_last(c) for c in EVENT_ORDER])


def event_id() -> Column:
    return stable_id(
        F.col(PLAYER),
        F.unix_micros("event_timestamp"),
        F.col("event_name"),
        F.col("param_level"),
        F.col("param_score"),
    )


def clean_events(raw: DataFrame) -> DataFrame:
    """Projects deduplicated raw events to the 31 staging columns, filling defaults."""

    def filled(column: str, default) -> Column:
        return F.coalesce(F.col(column), F.lit(default)).alias(column)

    return raw.select(
        event_id().alias("event_id"),
        PLAYER,
        F.coalesce("user_id", PLAYER).alias("user_id"),
        "user_first_touch_timestamp",
        "event_date",
        "event_timestamp",
        "event_name",
        F.coalesce("event_value_in_usd", F.lit(0.0)).alias("event_value_usd"),
        F.lower("platform").alias("platform"),
        filled("device_category", "unknown"),
        filled("device_brand", "unknown"),
        "device_model",
        "device_os",
        "device_os_version",
        filled("device_language", "en"),
        filled("geo_continent", "unknown"),
        filled("geo_country", "unknown"),
        "geo_region",
        "geo_city",
        filled("traffic_source", "direct"),
        filled("traffic_medium", "none"),
        "traffic_campaign",
        "param_level",
        "param_score",
        "param_board",
        "param_success",
        "param_value",
        "param_virtual_currency_name",
        F.coalesce("param_engagement_time_msec", F.lit(0).cast("bigint")).alias(
            "engagement_time_msec"
        ),
        "param_firebase_screen",
        "param_session_id",
    )


def stg_events(raw: DataFrame) -> DataFrame:
    return clean_events(dedup_events(with_player_and_time(raw)))


# Sessions -----------------------------------------------------------------------------------
#
# A session ends when the next event comes more than ``gap_minutes`` whole minutes later. Two
# events in the same clock slice of ``gap_minutes`` can never be split, so events are first
# reduced to one row per player and slice (partial aggregation happens before the shuffle), and
# only slices are ordered per player. A player with a third of all events is thus at most 48
# rows per day in the ordering step.


def _slice(gap_minutes: int) -> Column:
    return F.floor(F.unix_seconds("event_timestamp") / (gap_minutes * 60))


def _starts_session(previous: Column, current: Column, gap_minutes: int) -> Column:
    gap = F.timestamp_diff("MINUTE", previous, current)
    return F.when(gap.isNull() | (gap > gap_minutes), 1).otherwise(0)


def _number_slices(slices: DataFrame, gap_minutes: int) -> DataFrame:
    by_player = Window.partitionBy(PLAYER).orderBy("_slice")
    return slices.withColumn("_previous", F.lag("session_end").over(by_player)).withColumn(
        "session_num",
        F.sum(_starts_session(F.col("_previous"), F.col("session_start"), gap_minutes)).over(
            by_player
        ),
    )


def assign_sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Every event with the whole minutes since the player's previous one, and its session."""
    sliced = events.withColumn("_slice", _slice(gap_minutes))
    slices = _number_slices(
        sliced.groupBy(PLAYER, "_slice").agg(
            F.min("event_timestamp").alias("session_start"),
            F.max("event_timestamp").alias("session_end"),
        ),
        gap_minutes,
    ).select(PLAYER, "_slice", "_previous", "session_num")
    within = Window.partitionBy(PLAYER, "_slice").orderBy("event_timestamp", "event_id")
    before = F.coalesce(F.lag("event_timestamp").over(within), F.col("_previous"))
    return (
        sliced.join(slices, [PLAYER, "_slice"])
        .withColumn(
            "minutes_since_prev", F.timestamp_diff("MINUTE", before, F.col("event_timestamp"))
        )
        .drop("_slice", "_previous")
    )


# Event names of a session are counted by bitmaps: a name is a bit, and the bits of events, slices
# and sessions are or-ed. A session that never pauses thus keeps a few numbers, not a list.
_WORD_BITS = 63


def event_names(events: DataFrame) -> list[str]:
    """The dictionary of ``events``; reads that one column."""
    names = events.select("event_name").filter("event_name IS NOT NULL").distinct()
    return sorted(r[0] for r in names.collect())


def _words(names: Sequence[str]) -> range:
    return range(-(-len(names) // _WORD_BITS))


def _name_bits(names: Sequence[str]) -> list[Column]:
    """One long per 63 names, with the bits of the event names of a group."""
    if not names:
        return []
    places = F.create_map(*[F.lit(x) for pair in zip(names, range(len(names))) for x in pair])
    place = F.try_element_at(places, F.col("event_name"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place % _WORD_BITS)
    word = F.floor(place / _WORD_BITS)
    return [F.bit_or(F.when(word == w, bit)).alias(f"names_{w}") for w in _words(names)]


def _session_slices(events: DataFrame, gap_minutes: int, names: Sequence[str]) -> DataFrame:
    def times(name: str) -> Column:
        return F.count_if(F.col("event_name") == name)

    first = F.struct("event_timestamp", "event_id", "user_id", "platform", "geo_country")
    return (
        events.withColumn("_slice", _slice(gap_minutes))
        .groupBy(PLAYER, "_slice")
        .agg(
            F.min(first).alias("first"),
            F.min("event_timestamp").alias("session_start"),
            F.max("event_timestamp").alias("session_end"),
            F.min("event_date").alias("session_date"),
            F.sum("engagement_time_msec").alias("engagement_msec"),
            F.count(F.lit(1)).alias("events_count"),
            *_name_bits(names),
            F.sum("event_value_usd").alias("session_revenue"),
            F.max("param_level").alias("max_level_in_session"),
            times("level_start").alias("levels_started"),
            times("level_up").alias("levels_completed"),
            times("level_end").alias("levels_ended"),
            times("level_retry").alias("levels_retried"),
            times("post_score").alias("scores_posted"),
            F.max(F.when(F.col("event_name") == "post_score", F.col("param_score"))).alias(
                "best_score"
            ),
        )
    )


def _merge_slices(names: Sequence[str]) -> list[Column]:
    summed = (
        "engagement_msec",
        "events_count",
        "session_revenue",
        "levels_started",
        "levels_completed",
        "levels_ended",
        "levels_retried",
        "scores_posted",
    )
    return [
        F.min("first").alias("first"),
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        F.min("session_date").alias("session_date"),
        sum(
            [F.coalesce(F.bit_count(F.bit_or(f"names_{w}")), F.lit(0)) for w in _words(names)],
            F.lit(0),
        ).alias("unique_event_types"),
        F.max("max_level_in_session").alias("max_level_in_session"),
        F.max("best_score").alias("best_score"),
        *[F.sum(c).alias(c) for c in summed],
    ]


def session_id(number: Column | None = None) -> Column:
    """Of a player's session with this number; without one, of the session with this start."""
    numbers = [] if number is None else [number]
    return stable_id(F.col(PLAYER), *numbers, F.unix_micros("session_start"))


def session_columns(merged: DataFrame, identity: Column) -> DataFrame:
    """Merged events of sessions in the layout of the session table."""
    return merged.select(
        identity.alias("session_id"),
        PLAYER,
        F.col("first.user_id").alias("user_id"),
        "session_start",
        "session_end",
        "session_date",
        F.timestamp_diff("SECOND", F.col("session_start"), F.col("session_end")).alias(
            "session_duration_sec"
        ),
        (F.col("engagement_msec") / 1000.0).cast("double").alias("total_engagement_sec"),
        "events_count",
        F.col("unique_event_types").cast("bigint").alias("unique_event_types"),
        "session_revenue",
        "max_level_in_session",
        "levels_started",
        "levels_completed",
        "levels_ended",
        "levels_retried",
        "scores_posted",
        "best_score",
        F.col("first.platform").alias("platform"),
        F.col("first.geo_country").alias("geo_country"),
    )


def stg_sessions(
    events: DataFrame,
    gap_minutes: int = 30,
    names: Sequence[str] | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """One row per session. Player attributes are those of the session's first event.

    ``names`` are the event names there are, by default looked up in ``events``; others are not
    counted as types of events. ``before`` tells how many ``sessions`` players had before ``events``.
    """
    names = event_names(events) if names is None else names
    numbered = _number_slices(_session_slices(events, gap_minutes, names), gap_minutes)
    merged = numbered.groupBy(PLAYER, "session_num").agg(*_merge_slices(names))
    number = F.col("session_num")
    if before is not None:
        merged = merged.join(before.select(PLAYER, "sessions"), PLAYER, "left")
        number = number + F.coalesce("sessions", F.lit(0).cast("bigint"))
    return session_columns(merged, session_id(number))


def window_gap(gap_minutes: int) -> int:
    """Gap in microseconds for ``session_window``, which still merges an event at the gap's end."""
    return (gap_minutes + 1) * 60_000_000 - 1


def stg_sessions_windowed(
    events: DataFrame, gap_minutes: int = 30, names: Sequence[str] | None = None
) -> DataFrame:
    """The same sessions through Spark's ``session_window``.

    Each slice opens a window that reaches the gap beyond its own last event.
    """
    names = event_names(events) if names is None else names
    slices = _session_slices(events, gap_minutes, names)
    length = (
        F.unix_micros("session_end")
        - F.unix_micros("session_start")
        + F.lit(window_gap(gap_minutes))
    )
    reach = F.concat(length.cast("string"), F.lit(" microseconds"))
    merged = (
        slices.withColumn("at", F.col("session_start"))
        .groupBy(PLAYER, F.session_window("at", reach).alias("_window"))
        .agg(*_merge_slices(names))
    )
    by_player = Window.partitionBy(PLAYER).orderBy("session_start")
    numbered = merged.drop("_window").withColumn(
        "session_num", F.row_number().over(by_player).cast("bigint")
    )
    return session_columns(numbered, session_id(F.col("session_num")))
