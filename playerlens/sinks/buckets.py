"""Tables of the session catalog that are bucketed by a key.

Groupings by the key, and joins on it between tables with equally many buckets, need no shuffle. One
task reads a bucket, so this is for tables whose rows per key are bounded, such as rows per player and
day; facts, of which one player may have a third, are reduced first.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from playerlens.sinks.tables import _hadoop


def bucket_count(spark: SparkSession, paths: Sequence[str], per_bucket: int = 256 << 20) -> int:
    """A power of two, so that buckets of the largest of these folders hold about so many bytes."""
    largest = 0
    for path in paths:
        files, folder = _hadoop(spark, path)
        largest = max(largest, files.getContentSummary(folder).getLength())
    return 1 << max(0, -(-largest // per_bucket) - 1).bit_length()


def write_bucketed(
    df: DataFrame, name: str, path: str, key: str, buckets: int, partition: str | None = None
) -> None:
    """Stores ``df`` as the catalog table ``name`` in a new folder below ``path``, one file a bucket.

    With a ``partition`` column it is one file a bucket and partition. A table of that name gives way
    once all rows are written: a write that fails leaves it as it was. Its folder is kept for readers
    that have begun, and older folders go.
    """
    spark = df.sparkSession
    folder, new = f"{path}/_data-{uuid.uuid4().hex}", f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    if partition is not None:
        writer = writer.partitionBy(partition)
    before = location(spark, name) if spark.catalog.tableExists(name) else None
    writer.format("parquet").option("path", folder).saveAsTable(new)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    files, root = _hadoop(spark, path)
    kept = {folder.rpartition("/")[2], (before or "").rpartition("/")[2]}
    for status in files.listStatus(root):
        found = status.getPath().getName()
        if found.startswith("_data-") and found not in kept:
            files.delete(status.getPath(), True)


def replace_bucketed_days(df: DataFrame, name: str, days: Iterable[date]) -> None:
    """Puts ``df`` in the place of these days of a table that is partitioned by day.

    Days without rows in ``df`` are emptied; other days are not touched. The columns are taken by
    name. ``df`` is read twice: pass stored rows.
    """
    spark = df.sparkSession
    told = details(spark, name)
    key, day = told["Bucket Columns"].strip("[]`"), spark.table(name).columns[-1]
    rows = df.select(*spark.table(name).columns).repartition(int(told["Num Buckets"]), key)
    found = {r[0] for r in df.select(day).distinct().collect()}
    if not found <= set(days):
        raise ValueError(f"{name}: rows of other days than those to replace")
    if found:
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            rows.write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set(setting, before)
    for empty in sorted(set(days) - found):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({day} = DATE '{empty}')")


def details(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog knows about a table."""
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}


def location(spark: SparkSession, name: str) -> str:
    return details(spark, name)["Location"]
