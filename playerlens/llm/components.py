"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerlens.session import cut_lineage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
    ).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node with an edge; ``edges`` has ``u, v`` (long, not null).

    A component is named by its smallest node. Large-star and small-star steps alternate until
    nothing changes; every step is an aggregate and a join on the node, so a node with very many
    neighbours is combined map-side and split by the skew join. Each round's table is written to the
    shared folder. An edge of a node to itself makes it a component of its own.
    """
    edges = cut_lineage(edges.select("u", "v").distinct())
    loops = edges.filter("u = v").select(F.col("u").alias("node"))
    edges = edges.filter("u <> v")
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(low, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        edges = cut_lineage(small)
        now = _signature(edges)
        if now == before:
            break
        before = now
    named = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    alone = loops.select("node", F.col("node").alias("component"))
    return (
        named.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component"))
    )
