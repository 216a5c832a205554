"""Mixing sources to target weights by Pareto order sampling.

Every source has a target in words. A document's expected copies are its inclusion weight times a
factor that brings its source to the target, at most ``max_copies``. The whole copies are certain.
What is left over, a fraction between 0 and 1, is the document's inclusion probability: documents
are ordered by their random odds u / (1 - u) divided by their inclusion odds, and the sample takes
them in this order until the source's remaining words are filled. Its size is thus fixed up to one
document, whatever the documents' probabilities are.

The order is cut without sorting a source in one place: ranks fall into slices, words are summed by
slice, and only the slice in which the target falls is looked at more closely, twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playerlens.llm.text import space_words
from playerlens.session import cut_lineage

SLICES = 4096


def targets(sizes: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """``source, source_size, target`` from one row (``source, source_size``) for each source.

    Sources in code point order, null last, get ``weights`` in turn. All words are shared by
    weight; what exceeds ``max_copies`` times a source's size is shared among the others. One row
    for each source is sorted here, not one for each document.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("i", F.row_number().over(by_name) - 1)
    turn = F.array(*map(F.lit, weights))
    named = named.withColumn("weight", F.get(turn, F.col("i") % len(weights)).cast("long"))
    # Sources that reach their limit are those with the least limit for their weight.
    by_limit = everything.orderBy(F.col("source_size") / F.col("weight"), "i")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    limit = max_copies * F.col("source_size")
    level = named.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("share"),
        limit.alias("limit"),
    )
    free = F.col("limit") * F.col("share") >= F.col("weight") * F.col("left")
    level = level.withColumn("free", free)
    first = F.min(F.when(F.col("free"), F.struct(F.col("limit") / F.col("weight"), "i", "left", "share")))
    level = level.withColumn("level", first.over(everything))
    filled = F.col("weight") * F.col("level.left") / F.col("level.share")
    return level.select(
        "source",
        "source_size",
        F.least(F.col("limit").cast("double"), F.coalesce(filled, F.col("limit").cast("double"))).alias("target"),
    )


def uniform(doc_id: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 that any engine can compute from the id."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 48)


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = (5, 2, 1),
    max_copies: int = 3,
    weight: Column | None = None,
    seed: int = 10,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken`` (columns of those names go).

    ``size`` counts the words of the text, 0 for null. ``taken`` is ``copies * size``. ``weight``
    is a document's inclusion weight (default 1 for all; null or negative counts as 0). With
    weights that are not all equal a source reaches its target as far as ``max_copies`` allows.
    Rows of one id share their random number; rows equal in id and size may be taken in part.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    chosen = F.lit(1.0) if weight is None else F.greatest(F.coalesce(weight, F.lit(0.0)), F.lit(0.0))
    sized = docs.withColumns(
        {"size": space_words(F.col("text")), "_w": chosen.cast("double"), "_id": F.col("doc_id").cast("long")}
    )
    rows = cut_lineage(sized.select("_id", "source", "size", "_w"))
    plan = cut_lineage(_plan(rows, weights, max_copies))
    cuts = cut_lineage(_cuts(_ranked(rows, plan, max_copies, seed), plan))
    out = _ranked(sized, cuts, max_copies, seed)
    sampled = (F.col("_part") > 0) & (F.col("_rank") <= F.col("_cut"))
    copies = F.floor("_copies") + F.coalesce(sampled, F.lit(False)).cast("long")
    return out.select(
        *docs.columns,
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def _plan(rows: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """Target and factor of each source: sum of min(max_copies, factor * weight) * size."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sums, weights, max_copies).withColumn("_factor", F.lit(0.0))
    clipped = -1
    while True:
        plan = cut_lineage(plan)
        at_limit = (F.col("_factor") * F.col("_w") >= max_copies) & (F.col("_factor") > 0)
        parts = (
            _with_plan(rows, plan)
            .groupBy("source")
            .agg(
                F.sum(F.when(at_limit, F.col("size")).otherwise(0)).alias("full"),
                F.sum(F.when(at_limit, 0.0).otherwise(F.col("_w") * F.col("size"))).alias("open"),
                F.count_if(at_limit).alias("n"),
            )
        )
        parts = cut_lineage(parts)
        now = parts.agg(F.sum("n")).first()[0] or 0
        if now == clipped:
            return plan
        clipped = now
        left = F.col("target") - max_copies * F.col("full")
        factor = F.when(F.col("open") > 0, left / F.col("open")).otherwise(F.col("_factor"))
        new = parts.select(F.col("source").alias("_s"), "full", "open")
        plan = plan.join(new, plan["source"].eqNullSafe(new["_s"]))
        plan = plan.select("source", "source_size", "target", factor.alias("_factor"))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """One small row for each source; a source with very many rows is split by the join."""
    named = plan.withColumnRenamed("source", "_source")
    return rows.join(named, rows["source"].eqNullSafe(named["_source"])).drop("_source")


def _ranked(rows: DataFrame, plan: DataFrame, max_copies: int, seed: int) -> DataFrame:
    """Certain copies, inclusion probability and place in the Pareto order of each row.

    The ratio of odds q is mapped to q / (1 + q), which keeps the order and lies in (0, 1).
    """
    copies = F.least(F.lit(float(max_copies)), F.col("_factor") * F.col("_w"))
    u, part = F.col("_u"), F.col("_part")
    odds = (u / (1 - u)) / (part / (1 - part))
    out = _with_plan(rows, plan).withColumn("_copies", copies)
    out = out.withColumns({"_part": F.col("_copies") - F.floor("_copies"), "_u": uniform(F.col("_id"), seed)})
    out = out.withColumn("_v", F.when(part > 0, odds / (1 + odds)))
    return out.withColumn("_rank", F.struct("_v", F.coalesce("_id", F.lit(-1)).alias("_i"), F.col("size").alias("_n")))


def _fall(slices: DataFrame) -> DataFrame:
    """The slice of each source in which its remaining words run out, and what remains before it."""
    order = Window.partitionBy("source").orderBy("slice")
    to = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = slices.withColumn("to", to).withColumn("from", F.col("to") - F.col("words"))
    found = found.filter("from < left AND left <= to")
    return found.groupBy("source").agg(F.min("slice").alias("at"), F.max(F.col("left") - F.col("from")).alias("rest"))


def _cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``_cut``, the last place in the order that is taken; null when none is.

    Where the remaining words end inside a document, it is taken if that comes nearer.
    """
    names = F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")))
    rows = rows.withColumn("source", names)
    certain = rows.groupBy("source").agg(
        (F.max("target") - F.sum(F.floor("_copies") * F.col("size"))).alias("left"),
        F.sum(F.when(F.col("_part") > 0, F.col("size")).otherwise(0)).alias("open"),
        F.max(F.when(F.col("_part") > 0, F.col("_rank"))).alias("last"),
    )
    certain = cut_lineage(certain)
    rows = rows.filter(F.col("_part") > 0).select("source", "size", "_v", "_rank")
    first = F.least(F.floor(F.col("_v") * SLICES), F.lit(SLICES - 1))
    second = F.floor((F.col("_v") * SLICES - F.col("slice")) * SLICES)
    by = rows.withColumn("slice", first)
    sums = by.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    one = cut_lineage(_fall(sums.join(certain.select("source", "left"), "source")))
    inner = by.join(one, "source").filter("slice = at").withColumn("slice", second).drop("at")
    sums = inner.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.max("rest").alias("left"))
    two = cut_lineage(_fall(sums))
    inner = inner.drop("rest").join(two, "source").filter("slice = at")
    order = Window.partitionBy("source").orderBy("_rank")
    to = F.sum("size").over(order.rangeBetween(Window.unboundedPreceding, 0))
    near = inner.withColumn("to", to).filter((F.col("to") - F.col("rest")) <= F.col("size") / 2)
    inside = near.groupBy("source").agg(F.max("_rank").alias("inside"))
    # Nothing of the last narrow slice may be near enough; then the order ends before it.
    floor = two.join(one.select("source", F.col("at").alias("at1")), "source").select(
        "source", ((F.col("at1") + F.col("at") / SLICES) / SLICES).alias("edge")
    )
    found = (
        certain.join(floor, "source", "left")
        .join(inside, "source", "left")
        .select(
            F.col("source").alias("_source"),
            F.when(F.col("left") >= F.col("open"), F.col("last"))
            .when(F.col("left") <= 0, None)
            .otherwise(
                F.coalesce("inside", F.struct(F.col("edge").alias("_v"), F.lit(-2).cast("long").alias("_i"), F.lit(-1).cast("long").alias("_n")))
            )
            .alias("_cut"),
        )
    )
    keyed = plan.withColumn("_source", names)
    return keyed.join(found, "_source", "left").drop("_source")
