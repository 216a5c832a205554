"""A scratch folder for sessions that name none, so that the registered queries run anywhere."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def with_scratch(spark: SparkSession) -> SparkSession:
    """``spark``, with a temporary checkpoint folder if it has none and runs on one machine.

    On a cluster the folder has to be named in ``spark.checkpoint.dir``; nothing is made up there.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not named and not spark.conf.get("spark.checkpoint.dir", None):
        if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="playerlens-"))
    return spark
