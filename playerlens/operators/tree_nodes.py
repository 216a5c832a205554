"""Boosted trees as a table of nodes, which any SQL engine can read, explain and score with.

One row a node: ``tree``, ``node`` (0 is the root, numbered without gaps), ``feature`` and
``threshold`` (rows at or below it go to ``low``, others to ``high``; all null in a leaf),
``prediction``, ``weight`` (of the tree), ``row_weight`` (of the training rows that reached the node)
and ``gain``. A model has at most ``trees * 2 ** (depth + 1)`` of them, whatever it was trained on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "tree INT, node INT, feature STRING, threshold DOUBLE, low INT, high INT, prediction DOUBLE, "
    "weight DOUBLE, row_weight DOUBLE, gain DOUBLE"
)


def stored_nodes(spark: SparkSession, trees: str, columns: Sequence[str]) -> DataFrame:
    """The nodes of a boosted-trees model that Spark ML has saved at ``trees``.

    ``columns`` are the names of its features, in the order of the vector.
    """
    n = F.col("nodeData")
    splits = n["leftChild"] >= 0

    def of_split(value: Column) -> Column:
        return F.when(splits, value)

    names = F.array(*[F.lit(c) for c in columns])
    # Saved without names: the tree, its description and its weight.
    weights = spark.read.parquet(f"{trees}/treesMetadata").toDF("treeID", "described", "weights")
    return (
        spark.read.parquet(f"{trees}/data")
        .join(weights, "treeID")
        .select(
            F.col("treeID").alias("tree"),
            n["id"].alias("node"),
            of_split(F.get(names, n["split"]["featureIndex"])).alias("feature"),
            of_split(F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
            of_split(n["leftChild"]).alias("low"),
            of_split(n["rightChild"]).alias("high"),
            n["prediction"].alias("prediction"),
            F.col("weights").alias("weight"),
            F.get(n["impurityStats"], F.lit(0)).alias("row_weight"),
            of_split(n["gain"]).alias("gain"),
        )
    )


def _forest(nodes: DataFrame, columns: Sequence[str]) -> Column:
    """All nodes as one constant: an array of trees, each an array of nodes in order."""
    names = F.array(*[F.lit(c) for c in columns])
    place = F.when(
        F.col("feature").isNull() | F.array_contains(names, F.col("feature")),
        F.array_position(names, F.col("feature")).cast("int") - 1,
    ).otherwise(F.raise_error(F.concat(F.lit("no column for feature "), "feature")).cast("int"))
    node = F.struct(
        "node", place.alias("feature"), "threshold", "low", "high", "prediction"
    )
    trees = nodes.groupBy("tree").agg(
        F.any_value("weight").alias("weight"), F.sort_array(F.collect_list(node)).alias("nodes")
    )
    one = F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes")))
    return trees.agg(one).scalar()


def with_margin(
    df: DataFrame, nodes: DataFrame, columns: Sequence[str], depth: int, name: str = "margin"
) -> DataFrame:
    """Adds the weighted sum of the trees' predictions for each row's values in ``columns``.

    Each row walks every tree downwards in SQL functions. A null value goes high, as in SQL no
    comparison holds for it. Walks that are not in a leaf after ``depth`` steps are an error. Without
    trees the sum is 0.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])

    def prediction(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree["nodes"], at)
            return (
                F.when(node["low"].isNull(), at)
                .when(F.get(values, node["feature"]) <= node["threshold"], node["low"])
                .otherwise(node["high"])
            )

        steps = F.sequence(F.lit(1), F.lit(max(depth, 1)))
        leaf = F.get(tree["nodes"], F.aggregate(steps, F.lit(0), step))
        ended = F.when(leaf["low"].isNull(), leaf["prediction"])
        return ended.otherwise(F.raise_error(F.lit("a tree is deeper than stated")).cast("double"))

    total = F.aggregate("_forest", F.lit(0.0), lambda acc, t: acc + t["weight"] * prediction(t))
    # A column of its own: a subquery cannot stand inside a function of arrays.
    return (
        df.withColumn("_forest", _forest(nodes, columns))
        .withColumn(name, F.coalesce(total, F.lit(0.0)))
        .drop("_forest")
    )


def probability(margin: Column) -> Column:
    """Probability of the positive class, as boosted trees with logistic loss give it."""
    return 1.0 / (1.0 + F.exp(-2.0 * margin))


def importance(nodes: DataFrame) -> DataFrame:
    """Share of each feature in the gains of all splits, weighted by the rows they divide.

    Features of no split are left out.
    """
    gains = nodes.filter("feature IS NOT NULL").groupBy("feature").agg(
        F.sum(F.col("gain") * F.col("row_weight")).alias("gains")
    )
    total = gains.agg(F.sum("gains")).scalar()
    return gains.select("feature", F.try_divide("gains", total).alias("importance"))
