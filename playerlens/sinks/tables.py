"""Writing, appending, updating and trimming stored tables (parquet, one folder per table)."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from playerlens.operators.quality import LoadReport
from playerlens.operators.staging import dedup_latest
from playerlens.schemas import RawTable
from playerlens.session import cut_lineage

LAYERS = ("raw", "staging", "warehouse", "marts", "ml")
DAY = "_day"
#: Folders of a table's schema and of its list of versions; their names keep them out of the rows.
SCHEMA, VERSIONS = "_schema", "_versions"


def table_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; one of {', '.join(LAYERS)}")
    return f"{root}/{layer}/{name}"


def create_layers(spark: SparkSession, prefix: str = "game") -> list[str]:
    """A namespace per layer in the session catalog, where tables can be registered."""
    names = [f"{prefix}_{layer}" for layer in LAYERS]
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")
    return names


def register_table(spark: SparkSession, path: str, layer: str, name: str, prefix: str) -> str:
    """Makes a stored table readable by name, ``prefix_layer.name``, and returns that name.

    An entry of that name is replaced; the files are left alone.
    """
    full = f"`{prefix}_{layer}`.`{name}`"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.catalog.createTable(f"{prefix}_{layer}.{name}", current_path(spark, path), "parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(f"{prefix}_{layer}.{name}")):
        spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
    return f"{prefix}_{layer}.{name}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with the columns of all its loads, those of a load without a row among them.

    The schema is kept beside the rows and merged by each load, so no data file is opened to find it.
    Folders that were not written by ``write_table`` are read by their own schema.
    """
    versions = _versions(spark, path)
    if versions:
        schema = StructType.fromJson(json.loads(versions[0]["schema"]))
        return spark.read.schema(schema).parquet(f"{path}/{versions[0]['folder']}")
    schema = stored_schema(spark, path)
    return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """The file system of ``path``, and ``path`` in its terms."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def _lines(spark: SparkSession, path: str) -> list[str]:
    """Lines of a small text table; none if it is not there."""
    files, folder = _hadoop(spark, path)
    return [r[0] for r in spark.read.text(path).collect()] if files.exists(folder) else []


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    lines = _lines(spark, f"{path}/{SCHEMA}")
    return StructType.fromJson(json.loads(lines[0])) if lines else None


def merged_schema(stored: StructType | None, new: StructType, partition: str | None) -> StructType:
    """Fields of both, all nullable, new ones after the stored ones, the partition column last."""
    fields = {f.name: f.dataType for f in stored or []}
    for f in new:
        if fields.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(
                f"column {f.name} is {fields[f.name].simpleString()} in the table, "
                f"{f.dataType.simpleString()} in the load"
            )
    names = sorted(fields, key=lambda c: c == partition)
    return StructType([StructField(c, fields[c]) for c in names])


def laid_out(df: DataFrame, partition: str | None, cluster: Sequence[str] = ()) -> DataFrame:
    """Rows of a partition value together, sorted by the cluster columns inside a file.

    A rebalance instead of a repartition: a day with a third of all rows is split over tasks and
    files, and small days share one.
    """
    if partition is None:
        return df.sortWithinPartitions(*cluster) if cluster else df
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition: str | None = None,
    cluster: Sequence[str] = (),
    only_partitions: bool = False,
) -> int:
    """Stores ``df`` and returns its row count, counted during the write.

    ``only_partitions`` replaces just the partition values that ``df`` contains.
    """
    spark = df.sparkSession
    adds = mode == "append" or only_partitions
    if adds and _versions(spark, path):
        raise ValueError(f"{path} is replaced as a whole; it cannot be added to")
    before = stored_schema(spark, path) if adds else None
    schema = merged_schema(before, df.schema, partition)
    report = LoadReport(path)
    writer = report.watch(laid_out(df, partition, cluster)).write.mode(mode)
    if partition is not None:
        writer = writer.partitionBy(partition)
    if only_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    if schema != before:
        kept = spark.createDataFrame([(schema.json(),)], "schema string")
        kept.coalesce(1).write.mode("overwrite").text(f"{path}/{SCHEMA}")
    return report.result()["rows_loaded"]


def append_table(
    df: DataFrame, path: str, partition: str | None = None, cluster: Sequence[str] = ()
) -> int:
    """Adds rows; columns the table does not have yet are allowed, other types of one are not."""
    return write_table(df, path, "append", partition, cluster)


def load_raw(
    df: DataFrame, path: str, table: RawTable, mode: str = "append", only_partitions: bool = False
) -> int:
    """Loads normalised report rows into their raw table, by day of its time column."""
    by_day = df.withColumn(DAY, F.to_date(table.time_column))
    return write_table(by_day, path, mode, DAY, table.cluster_columns, only_partitions)


# Maintenance --------------------------------------------------------------------------------


def dedup_partition(df: DataFrame, table: RawTable, day: date | None = None) -> DataFrame:
    """Newest load of each key, of one day or of all."""
    rows = df
    if day is not None:
        at = F.col(table.time_column)
        rows = rows.filter(
            (at >= F.lit(day).cast("timestamp"))
            & (at < F.date_add(F.lit(day), 1).cast("timestamp"))
        )
    order = [F.desc_nulls_last("_ingestion_timestamp")]
    order += [c.asc() for c in tie_breaker(rows.columns, table)]
    return dedup_latest(rows, table.dedup_keys, order)


def tie_breaker(columns: Sequence[str], table: RawTable) -> list[Column]:
    """A hash that makes the choice among equally new rows of one key repeatable, least first."""
    others = [c for c in columns if c not in (*table.dedup_keys, "_ingestion_timestamp")]
    return [F.xxhash64(*others)] if others else []


def days_of(rows: DataFrame, table: RawTable) -> DataFrame:
    """The days that rows of a raw table belong to, one row each, as the column ``day``."""
    return rows.select(F.to_date(table.time_column).alias("day")).distinct()


def of_days(stored: DataFrame, days: date | DataFrame) -> DataFrame:
    """Rows of one day, or of those of a column ``day``, of a table that is stored by day.

    The days are looked up, as many as a calendar has, so that other folders are not read. A join on
    them would bring all rows of a day to one task.
    """
    if isinstance(days, date):
        return stored.filter(F.col(DAY) == F.lit(days))
    chosen = {r[0] for r in days.select(F.col("day").cast("date")).distinct().collect()}
    wanted = F.col(DAY).isin(sorted(d for d in chosen if d is not None))
    return stored.filter(wanted | F.col(DAY).isNull() if None in chosen else wanted)


def dedup_stored(
    spark: SparkSession, path: str, table: RawTable, days: date | DataFrame
) -> int:
    """Deduplicates one day, or those of a column ``day``, of a stored raw table in place.

    Other days are not touched.
    """
    rows = of_days(read_table(spark, path), days)
    kept = cut_lineage(dedup_partition(rows, table))
    return write_table(kept, path, "overwrite", DAY, table.cluster_columns, only_partitions=True)


def retained(df: DataFrame, column: str, ref_date: date, keep_days: int = 90) -> DataFrame:
    """Rows not older than ``keep_days`` before ``ref_date``."""
    return df.filter(F.col(column) >= F.lit(ref_date - timedelta(days=keep_days)))


def expire_partitions(
    spark: SparkSession, path: str, ref_date: date, keep_days: int = 90, column: str = DAY
) -> list[str]:
    """Deletes the day folders that ``retained`` would drop; no data file is read or rewritten."""
    oldest = ref_date - timedelta(days=keep_days)
    return _delete_partitions(spark, path, column, lambda day: day < oldest)


def _delete_partitions(
    spark: SparkSession, path: str, column: str, gone: Callable[[date], bool]
) -> list[str]:
    files, folder = _hadoop(spark, path)
    deleted = []
    for status in files.listStatus(folder):
        name, _, value = status.getPath().getName().partition("=")
        if name != column or value.startswith("__HIVE_DEFAULT"):
            continue
        if gone(date.fromisoformat(value)):
            files.delete(status.getPath(), True)
            deleted.append(value)
    return sorted(deleted)


def replace_partitions(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    partition: str,
    days: Sequence[date],
    cluster: Sequence[str] = (),
) -> int:
    """Puts ``df`` in the place of these days of a stored table; days it has no rows of are deleted.

    Returns the rows written. ``df`` is read twice: pass stored rows.
    """
    rows = write_table(df, path, "overwrite", partition, cluster, only_partitions=True)
    found = {r[0] for r in df.select(partition).distinct().collect()}
    empty = set(days) - found
    if empty:
        _delete_partitions(spark, path, partition, lambda day: day in empty)
    return rows


def update_from(
    target: DataFrame, source: DataFrame, key: str, assignments: dict[str, Column]
) -> DataFrame:
    """``target`` with columns replaced where ``source`` has its key; other rows stay as they are.

    Assignments may use columns of the source as ``src.<column>`` and the target's own. Two source
    rows for one key are an error.
    """
    values = F.struct(*[c for c in source.columns if c != key])
    once = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"several source rows for one {key}"))
    ).otherwise(F.any_value(values))
    matches = source.groupBy(key).agg(once.alias("src"))
    joined = target.join(matches, key, "left")
    matched = F.col("src").isNotNull()
    out = [
        F.when(matched, assignments[c]).otherwise(F.col(c)).alias(c)
        if c in assignments
        else F.col(c)
        for c in target.columns
    ]
    return joined.select(*out)


def rewrite_table(df: DataFrame, path: str) -> int:
    """Replaces a table, also one that ``df`` is computed from, in one step.

    The rows go to a new folder beside the old ones; then a line that names it is added to the
    table's list of versions. Until that line is there, readers find the version before, so a write
    that fails loses nothing. ``drop_versions`` clears old ones away.
    """
    spark = df.sparkSession
    folder = f"{path}/_data-{uuid.uuid4().hex}"
    report = LoadReport(path)
    report.watch(df).write.parquet(folder)
    entry = {"at": time.time_ns(), "folder": folder.rpartition("/")[2], "schema": df.schema.json()}
    line = spark.createDataFrame([(json.dumps(entry),)], "entry string")
    line.coalesce(1).write.mode("append").text(f"{path}/{VERSIONS}")
    return report.result()["rows_loaded"]


def _versions(spark: SparkSession, path: str) -> list[dict]:
    """Newest first; empty for a table that was never rewritten."""
    entries = [json.loads(x) for x in _lines(spark, f"{path}/{VERSIONS}")]
    return sorted(entries, key=lambda v: -v["at"])


def current_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the rows of a stored table now."""
    versions = _versions(spark, path)
    return f"{path}/{versions[0]['folder']}" if versions else path


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes the rows of all but the newest versions; returns how many went."""
    gone = 0
    for version in _versions(spark, path)[keep:]:
        files, folder = _hadoop(spark, f"{path}/{version['folder']}")
        gone += files.exists(folder) and bool(files.delete(folder, True))
    return gone
