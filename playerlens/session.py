"""Session settings and the shared folder for materialised intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Of a partition after a shuffle, as compressed. In memory rows of one day take up to 17 times as
#: much, so a task that sorts them for a write has over 1 GB at Spark's own 64 MB.
PARTITION_SIZE = "16m"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: UTC wall clock. ANSI and AQE stay at their defaults (on).

    Streamed sessions are merged inside each input partition before they are shuffled by player.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return spark


def prepare_for_tables(spark: SparkSession) -> SparkSession:
    """``prepare``, and partitions of ``PARTITION_SIZE`` unless the session names another size."""
    prepare(spark)
    if spark.conf.get(_ADVISED, None) is None:
        spark.conf.set(_ADVISED, PARTITION_SIZE)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder every executor sees.

    It is named in ``spark.checkpoint.dir``, or set by ``SparkContext.setCheckpointDir``.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
            "spark.checkpoint.dir", None
        )
        if configured:
            sc.setCheckpointDir(configured)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def side_by_side(spark: SparkSession, *steps: Callable[[], object], at_once: int = 8) -> list:
    """The results of ``steps`` that do not need each other, up to ``at_once`` of them at the same time.

    All of them end before the first error, in the order given, is raised.
    """
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared folder, so later passes read the same rows again.

    A written table: each row is computed once, later readers take the columns they need, and the
    result outlives the executors that computed it.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
