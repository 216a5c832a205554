"""Which days each player was active on, as bitmaps that a new day is or-ed into.

A row is a player and a span of 64 days: ``user_pseudo_id, span, bits``, bit n for the n-th day of
the span. Spans are partitions of the stored table, so a load reads its own events and the bitmaps
of its span, and rewrites those only.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playerlens.functions.columns import ratio
from playerlens.session import cut_lineage
from playerlens.settings import RETENTION_DAYS
from playerlens.sinks.tables import read_table, write_table

PLAYER = "user_pseudo_id"
SPAN = "span"
_DAYS = 64


def _span(day: Column) -> Column:
    return F.floor(F.unix_date(day) / _DAYS).cast("int")


def _bit(day: Column, ones: int = 1) -> Column:
    """The day's bit; with ``ones=-1`` also those of all later days of its span."""
    place = F.pmod(F.unix_date(day), F.lit(_DAYS))
    return F.call_function("shiftleft", F.lit(ones).cast("bigint"), place)


def activity_bitmaps(events: DataFrame) -> DataFrame:
    """Of events with a player and a date."""
    day = F.col("event_date")
    known = events.filter(F.col(PLAYER).isNotNull() & day.isNotNull())
    return known.groupBy(PLAYER, _span(day).alias(SPAN)).agg(F.bit_or(_bit(day)).alias("bits"))


def add_activity(spark: SparkSession, path: str, events: DataFrame) -> int:
    """Or-s the days of ``events`` into the bitmaps stored at ``path``; returns the rows written.

    Days may come late, in parts, or again.
    """
    new = cut_lineage(activity_bitmaps(events))
    spans = [r[0] for r in new.select(SPAN).distinct().collect()]
    if not spans:
        return 0
    stored = read_table(spark, path).filter(F.col(SPAN).isin(spans)).select(*new.columns)
    both = stored.unionByName(new).groupBy(PLAYER, SPAN).agg(F.bit_or("bits").alias("bits"))
    return write_table(cut_lineage(both), path, "overwrite", SPAN, only_partitions=True)


def replace_activity(
    spark: SparkSession, path: str, days: Sequence[date], events: DataFrame
) -> int:
    """Sets the bits of ``days`` to what ``events`` say, also where they say nothing any more."""
    masks: dict[int, int] = {}
    for day in days:
        n = (day - date(1970, 1, 1)).days
        masks[n // _DAYS] = masks.get(n // _DAYS, 0) | 1 << n % _DAYS
    mask = F.lit(0).cast("bigint")
    for span, bits in masks.items():
        whole = bits - (1 << _DAYS) if bits >> (_DAYS - 1) else bits  # as a signed number
        mask = F.when(F.col(SPAN) == span, F.lit(whole).cast("bigint")).otherwise(mask)
    stored = read_table(spark, path).filter(F.col(SPAN).isin(list(masks)))
    left = stored.select(PLAYER, SPAN, F.col("bits").bitwiseAND(F.bitwise_not(mask)).alias("bits"))
    new = activity_bitmaps(events.filter(F.col("event_date").isin(list(days))))
    both = left.unionByName(new).groupBy(PLAYER, SPAN).agg(F.bit_or("bits").alias("bits"))
    rows = cut_lineage(both.filter("bits <> 0"))
    return write_table(rows, path, "overwrite", SPAN, only_partitions=True)


def store_activity(path: str, events: DataFrame) -> int:
    """Starts the table of bitmaps."""
    return write_table(activity_bitmaps(events), path, "overwrite", SPAN)


def active_on(first: Column, after: int, span: Column, bits: Column) -> Column:
    """Whether ``bits`` of ``span`` hold the day that is ``after`` days later than ``first``."""
    day = F.date_add(first, after)
    return (span == _span(day)) & (bits.bitwiseAND(_bit(day)) != 0)


def retention_cohorts(
    users: DataFrame, bitmaps: DataFrame, days: Sequence[int] = RETENTION_DAYS
) -> DataFrame:
    """``marts.mart_retention_cohorts`` from bitmaps; no event is read."""
    cohort = ["cohort_date", "platform", "traffic_source"]
    installs = users.select(
        PLAYER, F.col("install_date").alias("cohort_date"), "platform", "traffic_source"
    )
    first, span, bits = F.col("cohort_date"), F.col(SPAN), F.col("bits")
    later = bits.bitwiseAND(_bit(first, ones=-1)) != 0
    since = (span > _span(first)) | ((span == _span(first)) & later)

    def was_active(after: int) -> Column:
        return F.max(active_on(first, after, span, bits).cast("int"))

    per_player = (
        installs.join(bitmaps, PLAYER)
        .filter(since)
        .groupBy(*cohort, PLAYER)
        .agg(was_active(0).alias("d0"), *[was_active(n).alias(f"d{n}") for n in days])
    )
    counts = per_player.groupBy(*cohort).agg(
        F.sum("d0").alias("cohort_size"), *[F.sum(f"d{n}").alias(f"d{n}_users") for n in days]
    )
    shares = [ratio(F.col(f"d{n}_users"), F.col("cohort_size")).alias(f"d{n}_retention") for n in days]
    return counts.select(
        *cohort, "cohort_size", *[f"d{n}_users" for n in days], *shares
    ).orderBy(F.desc("cohort_date"))


def daily_players(bitmaps: DataFrame) -> DataFrame:
    """Active players of each day: ``date, players``."""
    places = F.sequence(F.lit(0), F.lit(_DAYS - 1))
    set_bits = F.filter(
        places, lambda n: F.col("bits").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), n)) != 0
    )
    day = F.date_from_unix_date(F.col(SPAN) * _DAYS + F.col("n"))
    return (
        bitmaps.select(SPAN, F.explode(set_bits).alias("n"))
        .groupBy(SPAN, "n")
        .agg(F.count(F.lit(1)).alias("players"))
        .select(day.alias("date"), "players")
    )
