"""Global ranks without a single-partition window.

Rows are range-sorted over all partitions; the position inside a partition plus the size of the
partitions before it is the global rank. Only the partition sizes (one number per shuffle
partition) are looked at together. Sort keys must be unique, so that a value shared by most rows
can still be divided: append the row's key to them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playerlens.session import cut_lineage

# monotonically_increasing_id() keeps the partition above this bit and the position below it.
_POSITION_BITS = 33


def _placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` globally sorted and stored, with ``_part`` and ``_at`` (0-based) per row."""
    ranked = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    return cut_lineage(ranked).select(
        *df.columns,
        F.shiftright("_place", _POSITION_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_at"),
    )


def global_row_number(
    df: DataFrame, order: Sequence[Column | str], name: str = "row_number"
) -> DataFrame:
    """``row_number()`` over the whole of ``df`` in the given order, starting at 1."""
    placed = _placed(df, order)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per shuffle partition, hence safe to order in one task and to broadcast.
    before = sizes.select(
        "_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_before")
    )
    return (
        placed.join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_before") + F.col("_at") + 1)
        .select(*df.columns, name)
    )


def global_running_totals(
    df: DataFrame, order: Sequence[Column | str], totals: dict[str, str]
) -> DataFrame:
    """Sums over all rows *before* each row; ``totals`` maps output names to summed columns."""
    placed = _placed(df, order)
    sizes = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_{o}") for o, c in totals.items()])
    parts = Window.orderBy("_part")
    before = sizes.select(
        "_part",
        *[(F.sum(f"_{o}").over(parts) - F.col(f"_{o}")).alias(f"_before_{o}") for o in totals],
    )
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.join(F.broadcast(before), "_part")
        .select(
            *df.columns,
            *[
                (F.col(f"_before_{o}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(o)
                for o, c in totals.items()
            ],
        )
    )


@dataclass(frozen=True)
class Ordering:
    """One order of the rows: ascending keys, and which rows take part (all by default)."""

    keys: Sequence[Column]
    where: Column | None = None


def rows_at_ranks(
    df: DataFrame, orderings: Sequence[Ordering], ranks: Callable[[int], Sequence[int]]
) -> list[list[tuple]]:
    """Key values of the rows at a few given ranks (1-based), per ordering.

    All orderings are sorted in one go, so ``df`` is read once; their keys have to agree in number
    and types. ``ranks`` receives the row count of an ordering. Collects one number per ordering
    and shuffle partition, and the rows asked for.
    """
    names = [f"k{i}" for i in range(len(orderings[0].keys))]

    def entry(number: int, o: Ordering) -> Column:
        row = F.struct(F.lit(number).alias("_of"), *[k.alias(n) for k, n in zip(o.keys, names)])
        return row if o.where is None else F.when(o.where, row)

    entries = F.array(*[entry(i, o) for i, o in enumerate(orderings)])
    placed = _placed(df.select(F.inline(F.array_compact(entries))), ["_of", *names])

    sizes = sorted(tuple(r) for r in placed.groupBy("_of", "_part").count().collect())
    taken: dict[int, int] = {}  # positions of a partition that earlier orderings fill
    spots: list[list[tuple[int, int]]] = []
    for number in range(len(orderings)):
        own = [(part, size) for of, part, size in sizes if of == number]
        found = []
        for rank in ranks(sum(size for _, size in own)):
            before = 0
            for part, size in own:
                if rank <= before + size:
                    found.append((part, taken.get(part, 0) + rank - before - 1))
                    break
                before += size
        spots.append(found)
        for part, size in own:
            taken[part] = taken.get(part, 0) + size

    wanted = sorted({spot for found in spots for spot in found})
    if not wanted:
        return [[] for _ in orderings]
    hit = reduce(
        lambda a, b: a | b, [(F.col("_part") == p) & (F.col("_at") == at) for p, at in wanted]
    )
    rows = {
        (r["_part"], r["_at"]): tuple(r[n] for n in names) for r in placed.filter(hit).collect()
    }
    return [[rows[spot] for spot in found] for found in spots]


def at_or_before(df: DataFrame, keys: Sequence[Column], bound: tuple) -> Column:
    """Whether a row's keys sort no later than ``bound``; NULL sorts first, as in ORDER BY."""
    types = [f.dataType for f in df.select(*keys).schema]
    limit = F.struct(*[F.lit(v).cast(t) for v, t in zip(bound, types)])
    return F.struct(*keys) <= limit


def _bins(
    df: DataFrame,
    orderings: dict[str, Ordering],
    k: int,
    ranks: Callable[[int], Sequence[int]],
) -> dict[str, Column]:
    bounds = rows_at_ranks(df, list(orderings.values()), ranks)
    bins = {}
    for (name, ordering), found in zip(orderings.items(), bounds):
        bin_of = F.lit(k)
        for number in range(len(found), 0, -1):
            inside = at_or_before(df, ordering.keys, found[number - 1])
            bin_of = F.when(inside, number).otherwise(bin_of)
        bins[name] = bin_of
    return bins


def ntiles(df: DataFrame, orderings: dict[str, Ordering], k: int) -> dict[str, Column]:
    """``NTILE(k)`` over the whole of ``df`` per ordering, as expressions on its rows.

    Only the last row of each tile is looked up, so the rows themselves are not joined back. ``df``
    is read more than once: pass a stored table or ``cut_lineage`` output.
    """

    def ranks(n: int) -> list[int]:
        size, extra = divmod(n, k)
        ends = [size * b + min(b, extra) for b in range(1, k)]
        return [e for e in ends if e > 0]

    return _bins(df, orderings, k, ranks)


def quantile_bins(df: DataFrame, orderings: dict[str, Ordering], k: int) -> dict[str, Column]:
    """Equal-width bins 1..k of the rank per ordering, right-closed with linear edges.

    Differs from ``ntiles`` in where remainders go. A single row is in the top bin.
    """

    def ranks(n: int) -> list[int]:
        return [1 + (n - 1) * b // k for b in range(1, k)] if n > 1 else []

    return _bins(df, orderings, k, ranks)


def ntile(df: DataFrame, keys: Sequence[Column], k: int) -> Column:
    return ntiles(df, {"tile": Ordering(keys)}, k)["tile"]


def quantile_bin(df: DataFrame, keys: Sequence[Column], k: int) -> Column:
    return quantile_bins(df, {"bin": Ordering(keys)}, k)["bin"]


def with_row_key(df: DataFrame, name: str = "_row") -> DataFrame:
    """``df``, stored, with a unique id per row: the last sort key where the others are not unique."""
    return cut_lineage(df.withColumn(name, F.monotonically_increasing_id()))


def observed_quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, weight: str, quantiles: dict[str, float]
) -> DataFrame:
    """Exact quantiles per group: the least value up to which at least that share of the rows lies.

    ``counts`` has one row per group and value, so what a group's task orders are its distinct values;
    they need not fit in memory. NULL values count for nothing; a group of only those has no row.
    """
    group = Window.partitionBy(*keys)
    upto = F.sum(weight).over(group.orderBy(value))
    placed = counts.filter(F.col(value).isNotNull()).select(
        *keys, value, upto.alias("_upto"), F.sum(weight).over(group).alias("_all")
    )
    return placed.groupBy(*keys).agg(
        *[
            # As decimals: in doubles 0.95 of 20 rows is more than 19.
            F.min(F.when(F.col("_upto") >= F.lit(Decimal(str(q))) * F.col("_all"), F.col(value))).alias(name)
            for name, q in quantiles.items()
        ]
    )


def mean_rank_share(df: DataFrame, value: str) -> DataFrame:
    """Each distinct value with its rank as a share of all rows, ties at their mean rank."""
    histogram = df.groupBy(value).agg(F.count(F.lit(1)).alias("_ties"))
    ranked = global_running_totals(histogram, [value], {"_below": "_ties"})
    total = df.agg(F.count(F.lit(1))).scalar()
    share = (F.col("_below") + (F.col("_ties") + 1) / 2.0) / total
    return ranked.select(value, share.cast("double").alias("rank_share"))
