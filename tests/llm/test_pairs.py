"""Near duplicates, decontamination and vector search against plain Python."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from playerlens.llm import decontaminate, minhash, vectors
from playerlens.llm.components import components
from playerlens.llm.text import ALNUM, LOWER, WordHasher

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def find(parent, a):
    while parent[a] != a:
        a = parent[a]
    return a


def groups(texts):
    """Shingle counts and smallest reachable id, by comparing all pairs."""
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in texts}
    for a in texts:
        for b in texts:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(parent, i)) for i in texts}


def family(rng, n, words, edits):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("tiles", [(256, 2048), (3, 5)])
def test_components_equal_those_of_all_pairs(spark, documents, monkeypatch, tiles):
    monkeypatch.setattr(minhash, "LEFT_TILE", tiles[0])
    monkeypatch.setattr(minhash, "RIGHT_TILE", tiles[1])
    rng = random.Random(11)
    texts = family(rng, 60, 120, 5) + family(rng, 40, 40, 3) + family(rng, 20, 300, 30)
    texts += ["A b C", "a B c", "a b c d", "", " \t\n", None, "one", "ONE", "é ü É"] + ["same words again and again here"] * 30
    rng.shuffle(texts)
    table = {i * 3 + 7: t for i, t in enumerate(texts)}
    docs = documents(list(table.items())).withColumn("component_id", F.lit(-1))
    want = groups(table)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(table)
    for row in got:
        assert (row["n_shingles"], row["component_id"]) == want[row["doc_id"]]
        assert row["kept"] == (row["doc_id"] == row["component_id"])


def test_null_ids_repeated_rows_and_empty_tables(spark, documents):
    long = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(None, long), (None, long), (4, long), (4, long), (2, long), (9, None)]
    got = sorted(minhash.near_duplicates(documents(rows)).collect(), key=str)
    assert [(r[0], r[2], r[3]) for r in got] == sorted(
        [(None, None, True)] * 2 + [(4, 2, False)] * 2 + [(2, 2, True), (9, 9, True)], key=str
    ) or {(r[0], r[2], r[3]) for r in got} == {(None, None, True), (4, 2, False), (2, 2, True), (9, 9, True)}
    assert minhash.near_duplicates(documents([])).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    found = components(edges.union(spark.range(500, 501).selectExpr("id AS u", "id AS v"))).collect()
    assert {(r[0], r[1]) for r in found} == {(i, 0) for i in range(201)} | {(500, 500)}


def test_word_hashes_follow_the_words():
    texts = [None, b"", b" a  b\tA ", "é Ü ü".encode(), b"x" * 2_000_000 + b" a", b"a b"]
    for table in (LOWER, ALNUM):
        hasher = WordHasher(table)
        seen = {}
        for text, got in zip(texts, hasher.many(texts), strict=True):
            words = (text or b"").translate(table).split()
            assert len(words) == len(got)
            for w, h in zip(words, got.tolist(), strict=True):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def contaminated(docs, items, n=10):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    windows = defaultdict(set)
    for i, t in items:
        w = word(t)
        for k in range(max(1, len(w) - n + 1)) if w else ():
            windows[tuple(w[k : k + n])].add(str(i))
    out = {}
    for i, t in docs:
        w, hit, found = word(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (key := tuple(w[k : k + size])) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[key]
        out[i] = (len(w), len(hit), sorted(found))
    return out


@pytest.mark.parametrize("block_words", [200_000, 15])
def test_contamination_equals_brute_force(spark, documents, block_words):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcdef") + rng.choice("xy") for _ in range(n))
    items = [(i, text(rng.randint(8, 40))) for i in range(12)] + [(50, "ax"), (51, "bx CX dx"), (52, "!"), (53, None)]
    items += [(60, items[0][1]), (61, "ñandú ax bx")]
    docs = [(i, text(200)) for i in range(15)]
    docs += [(100 + i, f"{text(5)} {items[i][1].upper()}. {text(5)}") for i in range(12)]
    docs += [(200, None), (201, ""), (202, "ax"), (203, "zz ÑandÚ zz"), (204, "zz ñandú, AX bx"), (205, items[3][1])]
    want = contaminated(docs, items)
    table = spark.createDataFrame(items, "item_id long, text string")
    frame = documents(docs).withColumn("items", F.lit("mine"))
    got = decontaminate.contamination(frame, table, block_words=block_words).collect()
    for row in got:
        assert (row["n_words"], row["n_hit"], row["items"]) == want[row["doc_id"]], row["doc_id"]
    clean = decontaminate.decontaminate(frame, table, max_coverage=1.0, block_words=block_words)
    assert clean.columns == frame.columns
    rows = clean.collect()
    assert {r["items"] for r in rows} == {"mine"} and len(rows) == len(docs)
    left = contaminated([(r["doc_id"], r["text"]) for r in rows], items)
    assert all(hit == 0 for _, hit, _ in left.values())
    before = dict(docs)
    assert all(r["text"] == before[r["doc_id"]] for r in rows if want[r["doc_id"]][1] == 0)
    some = decontaminate.decontaminate(frame, table, max_coverage=0.5, block_words=block_words)
    assert {r["doc_id"] for r in some.collect()} == {i for i, (n, h, _) in want.items() if h <= n / 2}


def test_contamination_of_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents([(1, "a b"), (1, "a b"), (None, None)])
    assert [r["n_hit"] for r in decontaminate.contamination(docs, none).collect()] == [0, 0, 0]
    one = spark.createDataFrame([(None, "a b"), (1, "a b")], "item_id long, text string")
    assert sorted(r["n_hit"] for r in decontaminate.contamination(docs, one).collect()) == [0, 2, 2]
    assert decontaminate.contamination(documents([]), one).count() == 0


def neighbours(rows, queries, k):
    good = {
        i: v
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    dot = lambda a, b: math.fsum(x * y for x, y in zip(a, b, strict=True))
    out = {}
    for q in queries:
        if q in good:
            near = [
                (-dot(good[q], v) / math.sqrt(dot(v, v) * dot(good[q], good[q])), i)
                for i, v in good.items()
                if i != q and len(v) == len(good[q])
            ]
            out[q] = sorted((round(s, 12), i) for s, i in near)[:k]
    return out


@pytest.mark.parametrize("tiles", [(2048, 8192), (3, 7)])
def test_nearest_equals_brute_force(spark, tiles):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(60)]
    rows += [(60 + i, rows[0][1]) for i in range(12)] + [(80, [2 * x for x in rows[0][1]])]
    rows += [(90, None), (91, []), (92, [0.0] * 6), (93, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (94, [float("nan")] * 6)]
    rows += [(95, [float("inf"), 1.0, 1.0, 1.0, 1.0, 1.0]), (96, [1.0, 2.0]), (97, [1.0, 2.1]), (None, rows[1][1])]
    rows += [(98, [1e200, 1e200, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    ask = df.filter("vec_id % 3 = 0 OR vec_id > 89")
    got = defaultdict(list)
    for r in vectors.nearest(df, ask, query_tile=tiles[0], candidate_tile=tiles[1]).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = neighbours([r for r in rows if r[0] != 98], [i for i, _ in rows if i is not None and (i % 3 == 0 or i > 89)], 5)
    assert set(got) == set(want) | {98}
    for q, near in want.items():
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
        plain = [(round(-s, 12), i) for _, i, s in found if i != 98]
        assert plain == near[: len(plain)]
    empty = df.limit(0)
    assert vectors.nearest(empty, empty).count() == 0
    assert vectors.nearest(df, empty).count() == 0


@pytest.mark.parametrize("tiles", [(2048, 8192), (3, 7)])
def test_repeated_rows_take_no_neighbours_place(spark, tiles):
    rng = np.random.default_rng(9)
    once = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(30)]
    df = spark.createDataFrame(once * 2 + once[:3] * 7, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in vectors.nearest(df, df, query_tile=tiles[0], candidate_tile=tiles[1]).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"]))
    for q, near in neighbours(once, range(30), 5).items():
        assert sorted(got[q]) == [(k + 1, i) for k, (_, i) in enumerate(near)]
