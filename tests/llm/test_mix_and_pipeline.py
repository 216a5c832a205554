"""The mix, and the pipeline stage by stage."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from playerlens.llm import mixing, secrets
from tests.llm.test_pairs import contaminated, groups

SF = "/root/testdata/sf0.001"


def fill(sizes, weights=(5, 2, 1), copies=3):
    """Targets by raising one level until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:
        left = sum(sizes.values()) - sum(copies * sizes[s] for s in names if s not in open_)
        share = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / share > copies * sizes[s]}
        if not over:
            break
        open_ -= over
    return {s: left * weight[s] / share if s in open_ else float(copies * sizes[s]) for s in names}


@pytest.mark.parametrize("case", ["data", "limits", "odd"])
def test_sources_come_near_their_targets(spark, documents, case):
    if case == "data":
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    elif case == "limits":
        docs = documents([(i, "w " * (1 + i % 9), "en", f"s{min(i // 5, 6)}", 0) for i in range(400)])
    else:
        rows = [(i, "a b c", "en", (None, "", "é", "Z")[i % 4], 0) for i in range(60)]
        docs = documents(rows + [(None, None, None, None, None), (3, "a b c", "en", "Z", 0), (900, "x " * 50_000, "en", "big", 0)])
    out = mixing.mix(docs.withColumn("size", F.lit("mine")))
    rows = out.collect()
    assert len(rows) == docs.count()
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        s = r["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        largest[s] = max(largest.get(s, 0), r["size"])
    want = fill(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] * (1 if case == "odd" else 0.5) + 1e-6
    again = mixing.mix(docs).select("doc_id", "source", "taken")
    assert sorted(map(str, again.collect())) == sorted(str(r) for r in out.select("doc_id", "source", "taken").collect())


def test_inclusion_follows_the_weights(spark, documents):
    docs = documents([(i, "one two", "en", "ab"[i % 2], 0) for i in range(6000)])
    heavy = F.when(F.col("doc_id") % 4 < 2, 3.0).otherwise(1.0)
    out = mixing.mix(docs, weights=(1, 9), weight=heavy)
    means = {
        (r[0], r[1]): r[2]
        for r in out.groupBy("source", (F.col("doc_id") % 4 < 2).alias("h")).agg(F.avg("copies")).collect()
    }
    assert means["a", True] == pytest.approx(3 * means["a", False], rel=0.2)
    assert means["b", True] > means["b", False]


def test_empty_mix(spark, documents):
    assert mixing.mix(documents([])).count() == 0
    assert [r["taken"] for r in mixing.mix(documents([(1, None), (2, "")])).collect()] == [0, 0]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_dedup", "decontaminate", "secret_scan", "mixing"]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SF)
        before = {r["doc_id"]: r for r in now.collect()}
        after = {r["doc_id"]: r for r in out.collect()}
        assert set(after) <= set(before)
        if name == "mixing":
            assert out.columns == [*docs.columns, "copies"]
        else:
            assert out.schema.simpleString() == docs.schema.simpleString()
        if name == "language":
            assert all(before[i]["text"] is not None for i in after)
            assert len(after) > 0.97 * len(before)
        if name == "near_dedup":
            want = groups({i: r["text"] for i, r in before.items()})
            assert set(after) == {i for i, (_, c) in want.items() if c == i}
        if name == "decontaminate":
            hit = contaminated([(i, r["text"]) for i, r in before.items()], items)
            assert all(h == 0 for _, h, _ in contaminated([(i, r["text"]) for i, r in after.items()], items).values())
            assert all(i in after and after[i]["text"] == before[i]["text"] for i, (_, h, _) in hit.items() if h == 0)
        if name == "secret_scan":
            assert set(after) == set(before)
            found = secrets.scan(out)
            assert found.filter("size(assign) + size(access) + size(hex) > 0").count() == 0
        now = spark.createDataFrame(out.collect(), out.schema)


def test_pipeline_of_odd_tables(spark, documents, tmp_path):
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, None, None, None, None), (1, "the of and", "en", "s", 10), (1, "the of and", "en", "s", 10), (2, "x " * 40_000, None, None, None)]
    for table in (rows, []):
        docs = documents(table).withColumns({"score": F.lit("mine"), "items": F.lit(3), "size": F.lit(1)})
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        assert {"score", "items", "copies"} <= set(docs.columns)
        for r in docs.collect():
            assert r["score"] == "mine" and r["items"] == 3
