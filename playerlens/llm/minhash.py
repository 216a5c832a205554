"""Near-duplicate documents by circulant MinHash.

A document is its set of distinct five-word shingles (64-bit hashes). Two bijections of the 32-bit
ring make all signature coordinates: the first scatters the shingles, and coordinate ``k`` is the
least value of the second after shifting the ring by ``k``. ``rows`` coordinates in a row make one
of ``bands`` bucket keys; with 32 bands of 4, two sets at a similarity of 0.75 share no bucket with
a chance of 5e-6. Links are confirmed on the full sets.

Equal sets are merged before anything else. Inside a bucket not all pairs are formed: first every
document is compared with its bucket's pivot, the member that meets most others over all bands;
after joining what is linked, only members outside their bucket's largest component are compared
with the rest, tile by tile. Comparisons happen inside tasks on bounded tiles and only links leave
them, so families of any size are split over tasks and no link between candidates is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerlens.llm.components import components
from playerlens.llm.text import LOWER, WordHasher, mix64, signed, window_hashes
from playerlens.session import cut_lineage

LEFT_TILE, RIGHT_TILE = 256, 2048
_CHUNK = 1 << 16


def mix32(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles; fewer words than ``size`` make one shingle, no words none."""
    if len(words) == 0:
        return words
    return np.unique(window_hashes(words, min(size, len(words))))


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of circulant MinHash coordinates for each (not empty) set."""
    out = np.empty((len(sets), coordinates), np.uint32)
    at = 0
    while at < len(sets):
        to, n = at, 0
        while to < len(sets) and (to == at or n + len(sets[to]) <= _CHUNK):
            n += len(sets[to])
            to += 1
        first = mix32((np.concatenate(sets[at:to]) >> np.uint64(32)).astype(np.uint32))
        starts = np.cumsum([0, *map(len, sets[at : to - 1])])
        for k in range(coordinates):
            out[at:to, k] = np.minimum.reduceat(mix32(first + np.uint32(k)), starts)
        at = to
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    n, width = signature.shape
    parts = signature.reshape(n, width // rows, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(width // rows, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys


def _sketches(size: int, bands: int, rows: int):
    schema = pa.schema(
        {"doc_id": pa.int64(), "n_shingles": pa.int64(), "key1": pa.int64(), "key2": pa.int64()}
    ).append(pa.field("bands", pa.list_(pa.int64())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(LOWER)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                sets = [shingle_set(x, size) for x in hasher.many(texts)]
                keys = [xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else None for s in sets]
                wide = [i for i, s in enumerate(sets) if len(s) > 1]
                bucket = [[] for _ in sets]
                if wide:
                    found = band_keys(signatures([sets[i] for i in wide], bands * rows), rows)
                    for i, row in zip(wide, signed(found), strict=True):
                        bucket[i] = row
                low = np.array([(k or 0) & (1 << 64) - 1 for k in keys], np.uint64)
                high = np.array([(k or 0) >> 64 for k in keys], np.uint64)
                none = np.array([k is None for k in keys], bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(signed(low), pa.int64(), mask=none),
                        pa.array(signed(high), pa.int64(), mask=none),
                        pa.array(bucket, pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )

    return run


def _sets(size: int):
    schema = pa.schema({"member": pa.int64(), "shingles": pa.binary()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(LOWER)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                sets = [shingle_set(x, size).tobytes() for x in hasher.many(texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(sets, pa.binary())], schema=schema
                )

    return run


class _Tile:
    """The left sets of a tile, indexed by shingle."""

    def __init__(self, rows: list[tuple[int, int, np.ndarray]]):
        self.members = np.array([r[0] for r in rows], np.int64)
        self.labels = np.array([r[1] for r in rows], np.int64)
        self.sizes = np.array([len(r[2]) for r in rows], np.int64)
        shingles = np.concatenate([r[2] for r in rows])
        owners = np.repeat(np.arange(len(rows)), self.sizes)
        order = np.argsort(shingles, kind="stable")
        self.owners = owners[order]
        self.values, self.starts = np.unique(shingles[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(shingles))

    def linked(self, label: int, shingles: np.ndarray, percent: int) -> np.ndarray:
        if not len(self.values) or not len(shingles):
            return self.members[:0]
        at = np.minimum(np.searchsorted(self.values, shingles), len(self.values) - 1)
        at = at[self.values[at] == shingles]
        lengths = self.ends[at] - self.starts[at]
        flat = np.repeat(self.starts[at] - np.append(0, np.cumsum(lengths)[:-1]), lengths)
        shared = np.bincount(
            self.owners[flat + np.arange(len(flat))], minlength=len(self.members)
        )
        union = self.sizes + len(shingles) - shared
        return self.members[(100 * shared >= percent * union) & (self.labels != label)]


def _compare(percent: int):
    schema = pa.schema({"u": pa.int64(), "v": pa.int64()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, left, tile = None, [], None
        for batch in batches:
            u, v = [], []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != now:
                    now, left, tile = row[:2], [], None
                shingles = np.frombuffer(row[5], np.uint64)
                if row[2] == 0:
                    left.append((row[3], row[4], shingles))
                    continue
                if tile is None and left:
                    tile, left = _Tile(left), []
                if tile is not None:
                    for other in tile.linked(row[4], shingles, percent):
                        u.append(row[3])
                        v.append(int(other))
            yield pa.RecordBatch.from_pydict({"u": u, "v": v}, schema=schema)

    return run


def _links(tiles: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the left and right rows of each tile whose labels differ."""
    rows = (
        tiles.join(sets, "member")
        .select("g", "t", "side", "member", "label", "shingles")
        .repartition("g", "t")
        .sortWithinPartitions("g", "t", "side")
    )
    return rows.mapInArrow(_compare(percent), "u long, v long")


def _pivot_tiles(members: DataFrame) -> DataFrame:
    """One tile for each pivot and up to ``RIGHT_TILE`` of the documents it is compared with."""
    degree = members.groupBy("member").agg(F.sum("n").alias("degree"))
    pivots = (
        members.join(degree, "member")
        .groupBy("bucket")
        .agg(F.max_by("member", "degree").alias("g"))
    )
    pairs = (
        members.join(pivots, "bucket").filter("member <> g").select("g", "member").distinct()
    )
    pairs = cut_lineage(pairs)
    tiles = pairs.groupBy("g").agg(F.ceil(F.count("*") / RIGHT_TILE).alias("tiles"))
    left = tiles.select(
        "g",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("t"),
        F.lit(0).alias("side"),
        F.col("g").alias("member"),
    )
    right = pairs.join(tiles, "g").select(
        "g", F.pmod(F.xxhash64("member"), "tiles").alias("t"), F.lit(1).alias("side"), "member"
    )
    return left.union(right).withColumn("label", F.col("member"))


def _rest_tiles(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Tiles of what is outside its bucket's largest component against the whole bucket."""
    named = members.join(labels, F.col("member") == F.col("node"), "left").select(
        "bucket", "member", F.coalesce("component", "member").alias("label")
    )
    named = cut_lineage(named)
    parts = named.groupBy("bucket", "label").agg(F.count("*").alias("size"))
    plan = (
        parts.groupBy("bucket")
        .agg(F.max_by("label", "size").alias("main"), F.max("size").alias("most"), F.sum("size").alias("size"))
        .filter("size > most")
        .select(
            "bucket",
            "main",
            F.ceil((F.col("size") - F.col("most")) / LEFT_TILE).alias("lefts"),
            F.ceil(F.col("size") / RIGHT_TILE).alias("rights"),
        )
    )
    rows = named.join(plan, "bucket")
    tile = F.xxhash64("member")
    left = rows.filter("label <> main").select(
        "*",
        F.pmod(tile, "lefts").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("rights") - 1)).alias("j"),
        F.lit(0).alias("side"),
    )
    right = rows.select(
        "*",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("lefts") - 1)).alias("i"),
        F.pmod(tile, "rights").alias("j"),
        F.lit(1).alias("side"),
    )
    return left.unionByName(right).select(
        F.col("bucket").alias("g"),
        (F.col("i") * F.col("rights") + F.col("j")).alias("t"),
        "side",
        "member",
        "label",
    )


def near_duplicates(
    docs: DataFrame, *, size: int = 5, bands: int = 32, rows: int = 4, percent: int = 75
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row for each row of ``docs``.

    Documents are linked when 100 * intersection >= ``percent`` * union of their shingle sets.
    ``component_id`` is the smallest ``doc_id`` reachable. A null or wordless text has an empty set
    and is linked with nothing. A null ``doc_id`` is never linked: its component is null and it is
    kept. Rows that repeat an id count as one document.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = cut_lineage(
        docs.mapInArrow(
            _sketches(size, bands, rows),
            "doc_id long, n_shingles long, key1 long, key2 long, bands array<long>",
        )
    )
    narrow = sketches.select("doc_id", "n_shingles", "key1", "key2")
    usable = sketches.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = cut_lineage(
        usable.groupBy("key1", "key2").agg(F.min("doc_id").alias("member"), F.count("*").alias("n"))
    )
    bucketed = (
        usable.filter("n_shingles > 1")
        .join(classes.select("member", "key1", "key2"), ["key1", "key2"])
        .filter("doc_id = member")
        .select("member", F.explode("bands").alias("bucket"))
    )
    bucketed = cut_lineage(bucketed)
    shared = bucketed.groupBy("bucket").agg(F.count_distinct("member").alias("n")).filter("n > 1")
    members = cut_lineage(bucketed.join(shared, "bucket").distinct())
    wanted = members.select(F.col("member").alias("doc_id")).distinct()
    sets = cut_lineage(
        docs.join(wanted, "doc_id", "left_semi")
        .mapInArrow(_sets(size), "member long, shingles binary")
        .distinct()
    )
    first = cut_lineage(_links(_pivot_tiles(members), sets, percent))
    labels = components(first)
    second = _links(_rest_tiles(members, labels), sets, percent)
    # Rows that share an id join the sets they have.
    same = (
        usable.join(classes.filter("n > 1"), ["key1", "key2"])
        .filter("doc_id <> member")
        .select(F.col("doc_id").alias("u"), F.col("member").alias("v"))
    )
    final = components(first.union(second).union(same))
    return narrow.join(final, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )
