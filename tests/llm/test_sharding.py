"""Shards against a plain minimax partition, and the search for cuts on its own."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from playerlens.llm import sharding
from playerlens.llm.sharding import Ends, alone, minimax_cuts

SCHEMA = "doc_id long, text string"


def capacity(sizes, shards):
    """Smallest capacity, tried one after the other by halving."""

    def needed(c):
        n, now = 1, 0
        for s in sizes:
            if now + s > c:
                n, now = n + 1, 0
            now += s
        return n

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needed(middle) <= shards else (middle + 1, high)
    return low


def expected(rows, shards):
    """(doc_id, text) to shard."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[text].append(i)
    size = lambda t: len((t or "").encode()) + 8
    crc = lambda t: zlib.crc32((t or "").encode())
    first = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    place = lambda t: (first[t] is None, first[t] or 0, crc(t), size(t))
    total = {t: size(t) * len(ids) for t, ids in groups.items()}
    big = sorted(groups, key=lambda t: (-total[t], place(t)))
    shard, left = {}, sum(total.values())
    while len(shard) < shards - 1 and big and total[big[0]] * (shards - len(shard)) >= left:
        left -= total[big[0]]
        shard[big.pop(0)] = len(shard)
    rest = sorted(big, key=place)
    if rest:
        most = capacity([total[t] for t in rest], shards - len(shard))
        now, n = 0, len(shard)
        for t in rest:
            if now + total[t] > most:
                now, n = 0, n + 1
            now += total[t]
            shard[t] = n
    return shard


def check(spark, rows, shards=24, blocks=sharding.BLOCKS, extra=lambda df: df):
    df = extra(spark.createDataFrame(rows, SCHEMA))
    out = sharding.shard_rows(df, shards=shards, keep=("doc_id", "text"), blocks=blocks).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(rows)
    want = expected(rows, shards)
    slots = defaultdict(list)
    for r in out:
        data = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert r["shard"] == want[r["text"]]
        key = (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"])
        slots[r["shard"]].append((r["slot"], key))
    for found in slots.values():
        found.sort()
        assert [s for s, _ in found] == list(range(len(found)))
        assert [k for _, k in found] == sorted(k for _, k in found)
    return out


@pytest.mark.parametrize("blocks", [4, 16, 64, 1000])
def test_search_for_cuts(blocks):
    rng = random.Random(blocks)
    for _ in range(60):
        shards = rng.randint(1, 24)
        sizes = [rng.choice([8, rng.randint(8, 3000), rng.randint(8, 60)]) for _ in range(rng.randint(1, 400))]
        ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
        most = [0]

        def read(ranges, width):
            found = {}
            for v in ends:
                if any(a <= v <= b for a, b in ranges):
                    block = found.setdefault(v // width, [v, v, 0])
                    block[1:] = v, block[2] + 1
            most[0] = max(most[0], len(found))
            return [tuple(x) for x in found.values()]

        got, cuts = minimax_cuts(Ends(read, ends[-1], blocks), max(sizes), shards)
        assert got == capacity(sizes, shards)
        at = 0
        for cut in cuts:
            at = max((e for e in ends if e <= at + got), default=0)
            assert cut == at
        assert at == ends[-1]


def test_groups_of_their_own():
    assert alone([90, 5, 5], 100, 4) == 3
    assert alone([50, 26, 9, 9, 6], 100, 4) == 2
    assert alone([5, 5], 10, 24) == 2
    assert alone([], 0, 24) == 0
    assert alone([10], 10, 1) == 0


@pytest.mark.parametrize("blocks", [50, sharding.BLOCKS])
def test_equals_a_plain_partition(spark, blocks):
    rng = random.Random(4)
    texts = [None, "", "é" * 9, "hot copy " * 40, *["".join(rng.choices("ab ", k=rng.randint(0, 300))) for _ in range(500)]]
    rows = [(rng.choice([None, *range(3000)]), rng.choice(texts)) for _ in range(1500)]
    rows += [(None, "hot copy " * 40)] * 300 + [(5, None)] * 60
    check(spark, rows, blocks=blocks)
    check(spark, rows, shards=3)


def test_without_groups_sizes_are_nearly_equal(spark):
    rng = random.Random(6)
    rows = [(i, f"{i} " + "x" * rng.randint(0, 200)) for i in range(4000)]
    out = check(spark, rows)
    total = Counter()
    for r in out:
        total[r["shard"]] += r["size"]
    assert len(total) == 24 and max(total.values()) <= sum(total.values()) / 24 + 220


def test_odd_tables(spark):
    assert check(spark, []) == []
    clash = lambda df: df.withColumns({c: F.lit("mine") for c in ("size", "shard", "slot", "end", "_hash", "_id", "_row")})
    check(spark, [(1, "one")], extra=clash)
    check(spark, [(None, None)] * 3 + [(None, "")], extra=clash)
    check(spark, [(1, "long " * 200_000), (2, "a"), (2, "a"), (3, "b")], extra=clash)
    check(spark, [(i, "same") for i in range(50)])


def test_shard_files(spark, tmp_path):
    rows = [(i, f"text {i % 90} " * (i % 7)) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("extra", F.lit(1))
    sharding.write_shards(docs, f"{tmp_path}/out", shards=5)
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert set(stored.columns) == {"doc_id", "text", "extra", "size", "text_crc32", "shard", "slot"}
    want = expected(rows, 5)
    assert Counter((r["doc_id"], r["text"], r["shard"]) for r in stored.collect()) == Counter((i, t, want[t]) for i, t in rows)


def test_no_python_on_executors(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    plan = sharding.shard_rows(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
