"""Structured Streaming forms of landing, deduplication and sessionising."""

from __future__ import annotations

from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playerlens import schemas
from playerlens.operators.staging import session_columns, session_id, window_gap
from playerlens.session import cut_lineage
from playerlens.sinks.tables import DAY, days_of, load_raw, of_days, read_table, table_path, tie_breaker
from playerlens.sources.normalize import normalise_report
from playerlens.sources.readers import route_by_path

PLAYER = "user_pseudo_id"
LOAD = "_load"
BATCH = "_batch"


def stream_landing(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    csv_columns: dict[str, list[str]] | None = None,
    parquet_schemas: dict[str, T.StructType] | None = None,
) -> list[StreamingQuery]:
    """Loads the landing files that have come since the last run into their raw tables.

    One query per report type and format, started at once; each file is loaded once. Tables have the
    layout of the batch load, with the micro-batch in the column ``_load``: one that is retried after
    a failure first takes out what it had already written. CSV files have the given columns per report type, by default those of the raw table.
    """
    started = []
    locks = {name: Lock() for name in schemas.RAW_TABLES}
    for report_type, table in schemas.REPORT_TARGETS.items():
        plain = [f for f in table.schema if f.name not in ("_ingestion_timestamp", "_source")]
        names = (csv_columns or {}).get(report_type) or [f.name for f in plain]
        as_text = T.StructType([T.StructField(c, T.StringType()) for c in names])
        typed = (parquet_schemas or {}).get(report_type) or T.StructType(plain)
        for suffix, schema in (("csv", as_text), ("parquet", typed)):
            reader = spark.readStream.schema(schema).option("pathGlobFilter", f"*.{suffix}")
            if suffix == "csv":
                reader = reader.options(header=True, enforceSchema=False, mode="PERMISSIVE")
            files = reader.format(suffix).load(f"{landing}/t={report_type}/dt=*/*")
            started.append(
                files.select("*", F.col("_metadata.file_path").alias("_path"))
                .writeStream.foreachBatch(
                    _loader(root, f"{report_type}-{suffix}", table, locks[table.name])
                )
                .option("checkpointLocation", f"{checkpoint}/{report_type}-{suffix}")
                .trigger(availableNow=True)
                .start()
            )
    return started


def _loader(root: str, query: str, table: schemas.RawTable, lock: Lock):
    """Several queries feed one table; they write to its folder one after the other."""

    def load(batch: DataFrame, batch_id: int) -> None:
        routed = route_by_path(batch, F.col("_path")).drop(
            "_path", "report_type", "report_date", "target_table"
        )
        mine = f"{query}-{batch_id}"
        loaded = cut_lineage(
            normalise_report(routed, table.schema, "landing").withColumn(LOAD, F.lit(mine))
        )
        path = table_path(root, "raw", table.name)
        with lock:
            before = _already_written(batch.sparkSession, path, loaded, table, mine)
            if before is None:
                load_raw(loaded, path, table)
            else:
                both = before.drop(DAY).unionByName(loaded, allowMissingColumns=True)
                load_raw(cut_lineage(both), path, table, mode="overwrite", only_partitions=True)

    return load


def _already_written(
    spark: SparkSession, path: str, loaded: DataFrame, table: schemas.RawTable, mine: str
) -> DataFrame | None:
    """Other rows of the batch's days, if part of this micro-batch is stored already; else None."""
    try:
        stored = read_table(spark, path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if LOAD not in stored.columns:
        return None
    near = of_days(stored, days_of(loaded, table))
    if near.filter(F.col(LOAD) == mine).isEmpty():
        return None
    return near.filter(~F.col(LOAD).eqNullSafe(mine))


def stream_dedup(rows: DataFrame, table: schemas.RawTable, delay: str = "1 day") -> DataFrame:
    """Drops repeated keys that come within ``delay`` of each other.

    Keeps the first copy to arrive and lets it through at once; ``stream_newest`` waits for the
    newest, as the batch form does.
    """
    return rows.withWatermark(table.time_column, delay).dropDuplicatesWithinWatermark(
        list(table.dedup_keys)
    )


def stream_newest(rows: DataFrame, table: schemas.RawTable, delay: str = "1 day") -> DataFrame:
    """The newest copy of each key, as the batch form chooses it; use output mode append.

    The state of a key is one row, which a newer copy replaces; it comes out, once, when the
    watermark has passed the key's time, that is ``delay`` after the latest time seen. The time
    column is part of the key, so copies that come in time meet in the state. Later copies, and keys
    without a time, do not come out: load those with the batch form.
    """
    if table.time_column not in table.dedup_keys:
        raise ValueError(f"the time of {table.name} is not part of its key")
    others = [c for c in rows.columns if c not in table.dedup_keys]
    order = [F.col("_ingestion_timestamp")]
    order += [F.bitwise_not(c) for c in tie_breaker(rows.columns, table)]
    newest = (
        rows.withWatermark(table.time_column, delay)
        .groupBy(*table.dedup_keys)
        .agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_newest"))
    )
    return newest.select(
        *[F.col(f"_newest.{c}").alias(c) if c in others else F.col(c) for c in rows.columns]
    )


def _closed_sessions(events: DataFrame, gap_minutes: int, delay: str) -> DataFrame:
    name = F.col("event_name")
    first = F.struct("event_timestamp", "event_id", "user_id", "platform", "geo_country")
    return (
        events.withWatermark("event_timestamp", delay)
        .groupBy(
            PLAYER,
            F.session_window("event_timestamp", f"{window_gap(gap_minutes)} microseconds"),
        )
        .agg(
            F.min(first).alias("first"),
            F.min("event_timestamp").alias("session_start"),
            F.max("event_timestamp").alias("session_end"),
            F.min("event_date").alias("session_date"),
            F.sum("engagement_time_msec").alias("engagement_msec"),
            F.count(F.lit(1)).alias("events_count"),
            F.size(F.collect_set("event_name")).cast("bigint").alias("unique_event_types"),
            F.sum("event_value_usd").alias("session_revenue"),
            F.max("param_level").alias("max_level_in_session"),
            F.count_if(name == "level_start").alias("levels_started"),
            F.count_if(name == "level_up").alias("levels_completed"),
            F.count_if(name == "level_end").alias("levels_ended"),
            F.count_if(name == "level_retry").alias("levels_retried"),
            F.count_if(name == "post_score").alias("scores_posted"),
            F.max(F.when(name == "post_score", F.col("param_score"))).alias("best_score"),
        )
    )


def stream_sessions(events: DataFrame, gap_minutes: int = 30, delay: str = "1 hour") -> DataFrame:
    """Sessions as they close, with the gap rule of the batch form; use output mode append.

    A session comes out once the watermark has passed its end; events later than ``delay`` are
    dropped. Sessions are not numbered here, so the id is made of player and start.
    """
    return session_columns(_closed_sessions(events, gap_minutes, delay), session_id())


def stream_numbered_sessions(
    events: DataFrame,
    target: str,
    counters: str,
    checkpoint: str,
    gap_minutes: int = 30,
    delay: str = "1 hour",
    partitions: int = 32,
) -> StreamingQuery:
    """Writes sessions as they close, with the numbers and ids of the batch form, below ``target``.

    A player's sessions close in the order of their starts, so the number is how many the player had
    in earlier micro-batches, kept below ``counters``, plus the place in this one. A micro-batch
    writes its sessions and then the counts of the players it had, each to a folder of its own; one
    that is retried reads the counts from before it and writes both again. Processes what has come
    and stops; read the result with ``read_numbered_sessions``.

    The state of a new stream is divided into ``partitions``, or the session's shuffle partitions if
    those are fewer; a stream that goes on keeps its number. Each of them is opened and stored in
    every micro-batch, however few rows it has.
    """
    writer = (
        _closed_sessions(events, gap_minutes, delay)
        .writeStream.outputMode("append")
        .foreachBatch(_numberer(target, counters))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    # A stream keeps a copy of the settings it is started with.
    spark, setting = events.sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, min(partitions, int(before)))
    try:
        return writer.start()
    finally:
        spark.conf.set(setting, before)


#: Every so many micro-batches all counts are written, else those of the players in the micro-batch.
SNAPSHOT_EVERY = 16
_COUNTS = f"{PLAYER} string, sessions bigint"


def _counts_before(spark: SparkSession, counters: str, batch_id: int) -> DataFrame:
    """Sessions of each player in the micro-batches before this one. Counts only grow."""
    first = batch_id // SNAPSHOT_EVERY * SNAPSHOT_EVERY - 1
    paths = [f"{counters}/batch={k}" for k in range(max(first, 0), batch_id)]
    if not paths:
        return spark.createDataFrame([], _COUNTS)
    stored = spark.read.schema(_COUNTS).parquet(*paths)
    return stored.groupBy(PLAYER).agg(F.max("sessions").alias("sessions"))


def _numberer(target: str, counters: str):
    def number(batch: DataFrame, batch_id: int) -> None:
        closed = cut_lineage(batch)
        before = _counts_before(batch.sparkSession, counters, batch_id)
        place = F.row_number().over(Window.partitionBy(PLAYER).orderBy("session_start"))
        so_far = F.coalesce("sessions", F.lit(0).cast("bigint"))
        numbered = closed.join(before, PLAYER, "left").withColumn("session_num", so_far + place)
        sessions = session_columns(numbered, session_id(F.col("session_num")))
        sessions.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")
        here = closed.groupBy(PLAYER).agg(F.count(F.lit(1)).alias("_new"))
        whole = (batch_id + 1) % SNAPSHOT_EVERY == 0
        counts = here.join(before, PLAYER, "full" if whole else "left").select(
            PLAYER, (so_far + F.coalesce("_new", F.lit(0))).alias("sessions")
        )
        counts.write.mode("overwrite").parquet(f"{counters}/batch={batch_id}")

    return number


def read_numbered_sessions(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop(BATCH)


def keep_state_on_disk(spark: SparkSession) -> SparkSession:
    """State of streams in RocksDB, beside the heap; a stream stays with the store it began with."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return spark
