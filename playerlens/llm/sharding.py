"""Shards of nearly equal size: a minimax contiguous partition of ordered atomic groups.

Rows with equal texts are one group and stay together; groups are laid side by side in the order of
their smallest ``doc_id``. The smallest capacity for which cutting greedily needs no more shards than
there are is found by binary search, and the groups are cut there. A group that alone is as large as
the mean of what is left gets a shard of its own first, so it does not decide the capacity of others.

The ends of the groups stay in a Spark table. The search looks at blocks of it, of which the driver
holds the first and last end and the count. A capacity is checked with bounds from these blocks, and
only the blocks in which a cut may lie are read again, in finer blocks, until no bound is open. Every
round returns at most ``blocks`` rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerlens.operators.ranking import global_row_number, global_running_totals
from playerlens.session import cut_lineage

SHARDS = 24
ROW_BYTES = 8
BLOCKS = 1 << 15


@dataclass
class Ends:
    """What is known of an ascending list of numbers: disjoint blocks with first, last and count.

    ``read(ranges, width)`` returns such blocks of the numbers in ``ranges``, cut at multiples of
    ``width``.
    """

    read: Callable[[list[tuple[int, int]], int], Sequence[tuple[int, int, int]]]
    total: int
    blocks: int

    def __post_init__(self):
        self._hold(self.read([(1, self.total)], -(-self.total // self.blocks)))

    def _hold(self, found: Sequence[tuple[int, int, int]]) -> None:
        self.known = sorted(tuple(x) for x in found)
        self.first = [x[0] for x in self.known]

    def floor(self, low: int, high: int) -> tuple[int, int, range]:
        """Bounds of the largest number at most ``y``, for any ``y`` from ``low`` to ``high``, and
        the blocks that would have to be known better."""
        a, b = bisect_right(self.first, low) - 1, bisect_right(self.first, high) - 1
        return self._below(a, low)[0], self._below(b, high)[1], range(max(a, 0), b + 1)

    def _below(self, i: int, y: int) -> tuple[int, int]:
        if i < 0:
            return 0, 0
        first, last, n = self.known[i]
        if last <= y:
            return last, last
        return first, first if n <= 2 else y

    def refine(self, wanted: set[int]) -> None:
        """Replaces blocks by finer ones."""
        ranges: list[tuple[int, int]] = []
        for i in sorted(wanted):
            first, last, _ = self.known[i]
            if ranges and i - 1 in wanted:
                ranges[-1] = (ranges[-1][0], last)
            else:
                ranges.append((first, last))
        span = sum(b - a + 1 for a, b in ranges)
        single = sum(self.known[i][2] for i in wanted) <= self.blocks
        # Each range may begin and end inside a block of the grid. The widest block is always cut, so
        # the search ends also with few blocks.
        widest = max(self.known[i][1] - self.known[i][0] + 1 for i in wanted)
        n = max(1, self.blocks - 2 * len(ranges))
        width = 1 if single else min(-(-span // n), -(-widest // 2))
        rest = [x for i, x in enumerate(self.known) if i not in wanted]
        self._hold([*rest, *self.read(ranges, width)])


def greedy(ends: Ends, low: int, high: int, shards: int) -> tuple[list[tuple[int, int]], set[int]]:
    """Bounds of the cuts for any capacity from ``low`` to ``high``, and the blocks left open."""
    cuts, unclear, a, b = [], set(), 0, 0
    for _ in range(shards):
        a, b, touched = ends.floor(a + low, b + high)
        unclear |= {i for i in touched if ends.known[i][2] > 2}
        cuts.append((a, b))
    return cuts, unclear


def minimax_cuts(ends: Ends, largest: int, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity, and the ends at which ``shards`` shards of it are cut."""
    total = ends.total
    least = max(largest, -(-total // shards))
    most = least + largest
    while True:
        # The smallest capacity known to suffice (the largest one always does), and the smallest not
        # known to fail.
        reach = range(least, most + 1)
        enough = bisect_left(reach, True, key=lambda c: greedy(ends, c, c, shards)[0][-1][0] >= total)
        maybe = bisect_left(reach, True, key=lambda c: greedy(ends, c, c, shards)[0][-1][1] >= total)
        enough, maybe = min(most, least + enough), least + maybe
        cuts, unclear = greedy(ends, maybe, enough, shards)
        if maybe == enough and all(a == b for a, b in cuts):
            return enough, [a for a, _ in cuts]
        ends.refine(unclear)
        least, most = maybe, enough


def alone(sizes: Sequence[int], total: int, shards: int) -> int:
    """How many of the largest groups (falling ``sizes``) are at least the mean of what is left."""
    n = 0
    while n < min(len(sizes), shards - 1) and sizes[n] * (shards - n) >= total:
        total -= sizes[n]
        n += 1
    return n


def _ends_of(groups: DataFrame, total: int, blocks: int) -> Ends:
    """The blocks of the column ``end``."""

    def read(ranges: list[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
        inside = F.lit(False)
        for a, b in ranges:
            inside = inside | F.col("end").between(a, b)
        blocked = groups.filter(inside).groupBy(F.expr(f"end div {width}").alias("_block"))
        found = blocked.agg(F.min("end"), F.max("end"), F.count("*")).drop("_block")
        return [tuple(r) for r in found.collect()]

    return Ends(read, total, blocks)


def shard_rows(
    docs: DataFrame, *, shards: int = SHARDS, keep: Sequence[str] = ("doc_id",), blocks: int = BLOCKS
) -> DataFrame:
    """The columns ``keep`` of every row with ``size, text_crc32, shard, slot``.

    ``size`` is 8 and the text's UTF-8 bytes; a null text has none and is not equal to an empty one.
    Rows of equal texts share a shard. ``slot`` numbers a shard's rows from 0 by ``doc_id`` (null
    last), size and checksum; rows equal in these are in any order. Kept columns called like the new
    ones are replaced. Shards that no group is left for are empty; so are all for an empty table.
    """
    made = ("size", "text_crc32", "shard", "slot")
    kept = {f"_keep{i}": c for i, c in enumerate(c for c in keep if c not in made)}
    rows = cut_lineage(
        docs.select(
            *[F.col(c).alias(k) for k, c in kept.items()],
            F.col("doc_id").alias("_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            # 96 bits of hash and the length stand for the text; a clash would only join two groups.
            F.xxhash64("text").alias("_hash"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    key = ["size", "text_crc32", "_hash"]
    groups = rows.groupBy(*key).agg(F.min("_id").alias("_first"), (F.count("*") * F.col("size")).alias("_bytes"))
    groups = cut_lineage(groups)
    order = [F.asc_nulls_last("_first"), "text_crc32", "size", "_hash"]
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    top = groups.orderBy(F.desc("_bytes"), *order).limit(shards).collect()
    n = alone([r["_bytes"] for r in top], total, shards)
    rest = groups
    own_shard = F.lit(None).cast("int")
    for i, r in reversed(list(enumerate(top[:n]))):
        this = F.lit(True)
        for c in key:
            this = this & (F.col(c) == r[c])
        rest = rest.filter(~this)
        own_shard = F.when(this, i).otherwise(own_shard)
        total -= r["_bytes"]
    placed = rows.withColumn("shard", own_shard)
    if total:
        ended = global_running_totals(rest, order, {"_before": "_bytes"})
        ended = cut_lineage(ended.select(*key, (F.col("_before") + F.col("_bytes")).alias("end")))
        _, cuts = minimax_cuts(_ends_of(ended, total, blocks), top[n]["_bytes"], shards - n)
        passed = [F.when(F.col("end") > c, 1).otherwise(0) for c in sorted({c for c in cuts if c < total})]
        number = sum(passed, F.lit(n)).cast("int")
        placed = rows.join(ended.select(*key, number.alias("_shard")), key, "left")
        placed = placed.withColumn("shard", F.coalesce("_shard", own_shard)).drop("_shard")
    placed = cut_lineage(placed)
    before, slots = 0, {}
    for s, count in sorted(tuple(r) for r in placed.groupBy("shard").count().collect()):
        slots[s] = before
        before += count
    first = F.lit(0).cast("long")
    for s, at in slots.items():
        first = F.when(F.col("shard") == s, F.lit(at).cast("long")).otherwise(first)
    by = ["shard", F.asc_nulls_last("_id"), "size", "text_crc32", "_hash", "_row"]
    numbered = global_row_number(placed, by, "_number")
    return numbered.select(
        *[F.col(k).alias(c) for k, c in kept.items()],
        "size",
        "text_crc32",
        "shard",
        (F.col("_number") - 1 - first).alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, *, shards: int = SHARDS, blocks: int = BLOCKS) -> None:
    """Stores all columns of ``docs`` below ``path/shard=<n>``, in the order of their slots.

    A shard may be several files; their names ascend with the slot.
    """
    out = shard_rows(docs, shards=shards, keep=docs.columns, blocks=blocks)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
