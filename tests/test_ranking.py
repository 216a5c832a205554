import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from playerlens.operators import ranking, segments


@pytest.fixture(scope="module", autouse=True)
def several_partitions(spark):
    """Small data would otherwise be merged into one partition, where nothing can go wrong."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def tied(spark):
    """20,000 rows of which nine in ten share one value."""
    value = F.when(F.col("id") % 10 == 0, F.pmod(F.xxhash64("id"), F.lit(50))).otherwise(0)
    return spark.range(20000, numPartitions=7).select("id", value.alias("v"))


def test_row_number_equals_one_window(tied):
    ours = ranking.global_row_number(tied, ["v", "id"], "rn")
    one = tied.withColumn("rn", F.row_number().over(Window.orderBy("v", "id")))
    assert ours.exceptAll(one).count() == 0 and ours.count() == 20000


def test_running_totals_equal_one_window(tied):
    ours = ranking.global_running_totals(tied, ["v", "id"], {"before": "v"})
    before = Window.orderBy("v", "id").rowsBetween(Window.unboundedPreceding, -1)
    one = tied.withColumn("before", F.coalesce(F.sum("v").over(before), F.lit(0)))
    assert ours.exceptAll(one).count() == 0


def test_a_value_most_rows_share_is_divided(tied):
    """The sort key ends in the row's id, so no partition gets all rows of the common value."""
    placed = ranking._placed(tied, ["v", "id"])
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 20000 / 2


def test_ntile_equals_one_window(tied):
    keys = [F.col("v"), F.col("id")]
    ours = tied.withColumn("tile", ranking.ntile(tied, keys, 4))
    one = tied.withColumn("tile", F.ntile(4).over(Window.orderBy("v", "id")))
    assert ours.exceptAll(one).count() == 0


@pytest.mark.parametrize("k", [4, 7])
def test_repeated_rows_are_divided_at_the_edge_of_a_bin(spark, k):
    """Every key is there 30 times, so bins end between equal rows."""
    df = spark.range(3000, numPartitions=5).select((F.col("id") % 100).alias("v"))
    rows = ranking.with_row_key(df)
    keys = [F.col("v"), F.col("_row")]
    counted = lambda c: {(r["v"], r["b"]): r["count"] for r in c.groupBy("v", "b").count().collect()}
    one = df.withColumn("b", F.ntile(k).over(Window.orderBy("v")))
    assert counted(rows.withColumn("b", ranking.ntile(rows, keys, k))) == counted(one)
    rank = F.row_number().over(Window.orderBy("v"))
    cut = df.withColumn("b", F.greatest(F.lit(1), F.ceil(k * (rank - 1) / (3000 - 1))))
    assert counted(rows.withColumn("b", ranking.quantile_bin(rows, keys, k))) == counted(cut)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 9])
def test_small_bins(spark, n):
    df = spark.range(n).select("id")
    tiles = df.select("id", ranking.ntile(df, [F.col("id")], 4).alias("b"))
    one = df.select("id", F.ntile(4).over(Window.orderBy("id")).alias("b"))
    assert tiles.exceptAll(one).count() == 0
    bins = df.select("id", ranking.quantile_bin(df, [F.col("id")], 4).alias("b"))
    got = [r["b"] for r in bins.orderBy("id").collect()]
    if n == 1:
        assert got == [4]
    else:
        cut = pd.qcut(pd.Series(range(1, n + 1)), q=4, labels=[1, 2, 3, 4])
        assert got == cut.astype(int).tolist()


def test_no_rows(spark):
    none = spark.range(0).select("id")
    assert ranking.global_row_number(none, ["id"]).count() == 0
    assert none.withColumn("b", ranking.ntile(none, [F.col("id")], 4)).count() == 0


def test_nulls_sort_first(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c"), (2, "d")], "v INT, k STRING")
    tiles = df.select("k", ranking.ntile(df, [F.col("v"), F.col("k")], 4).alias("b"))
    assert {r[0]: r[1] for r in tiles.collect()} == {"a": 1, "b": 2, "c": 3, "d": 4}


def test_mean_rank_share_equals_pandas(spark):
    values = [5.0, 1.0, 5.0, 2.0, 2.0, 2.0, 9.0]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    got = {r[0]: r[1] for r in ranking.mean_rank_share(df, "v").collect()}
    want = pd.Series(values).rank(pct=True)
    for v, share in zip(values, want):
        assert got[v] == pytest.approx(share)


METRICS = (
    "user_pseudo_id STRING, recency INT, frequency INT, monetary DOUBLE, "
    "avg_session_duration DOUBLE, max_level INT, purchase_count INT"
)


def players(spark, rows):
    return spark.createDataFrame(
        [(f"p{i:03}", r, f, m, 10.0, 5, 1) for i, (r, f, m) in enumerate(rows)], METRICS
    )


def test_segments_without_and_with_one_payer(spark):
    free = [(0, 9, 0.0), (5, 4, 0.0), (20, 1, 0.0), (2, 1, 0.0)]
    none = segments.segment_players(players(spark, free))
    assert {r["spend_percentile"] for r in none.collect()} == {0.0}
    one = segments.segment_players(players(spark, [*free, (0, 9, 4.0)]))
    payer = one.filter("monetary > 0").first()
    assert (payer["m_score"], payer["spend_percentile"]) == (4, 1.0)
    assert payer["player_segment"] == "whale"
    assert one.count() == 5


def test_top_payer_with_low_frequency_matches_no_payer_rule(spark):
    rows = [(0, 9, 1.0)] * 59 + [(9, 1, 100.0)]
    got = segments.segment_players(players(spark, rows)).filter("monetary = 100").first()
    assert got["spend_percentile"] == 1.0 and got["f_score"] < 3
    assert got["player_segment"] == "churned"


def test_negative_and_unknown_spend_drop_out(spark):
    rows = [(0, 1, -1.0), (0, 1, None), (0, 1, 0.0), (0, 1, 2.0)]
    assert segments.rfm_scores(players(spark, rows)).count() == 2


def test_segment_shares(spark):
    rows = [(0, 9, 0.0)] * 3 + [(30, 1, 0.0)] * 5
    stats = segments.segment_stats(segments.segment_players(players(spark, rows))).collect()
    assert sum(r["user_count"] for r in stats) == 8
    assert sum(r["pct_of_total"] for r in stats) == pytest.approx(100)
    assert {r["revenue_share"] for r in stats} == {0.0}


def test_registered_bins_divide_equal_lines(spark, tmp_path):
    """The queries, on order lines of which every one is there three times."""
    lines = spark.range(101).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(0.1).alias("l_discount")
    )
    lines.crossJoin(spark.range(3).select(F.lit(None).cast("int").alias("x"))).drop("x").write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    for name, column, k in (("quantile_bin", "bin", 4), ("distributed_ntile", "tile", 7)):
        got = entry.queries()[name](spark, str(tmp_path)).groupBy(column).count().collect()
        assert sorted(r["count"] for r in got) == sorted(
            len(x) for x in (pd.Series(range(303)).groupby(
                pd.qcut(pd.Series(range(303)), k, labels=False) if column == "bin" else
                pd.Series(range(303)).map(lambda i: i // 44 if i < 88 else 2 + (i - 88) // 43)
            ).groups.values())
        )
