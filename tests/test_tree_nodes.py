"""Trees as rows: training against a plain search, scores against another engine, importances."""

import math
import random
from datetime import date, datetime
from threading import Barrier

import duckdb
import pytest
from pyspark.ml import PipelineModel

from playerlens.operators import churn, tree_nodes
from playerlens.settings import ChurnSettings

COLUMNS = ["a", "b", "c"]
EXACT = ChurnSettings(
    n_trees=4, max_depth=3, learning_rate=0.3, row_sampling=1.0, column_sampling="all",
    min_rows_per_leaf=4, folds=0,
)


def players(n=160, seed=5):
    """Few distinct values a column, so that every cut between two of them is tried in training."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        x = [float(rng.randrange(9)), float(rng.randrange(7)), float(rng.randrange(5))]
        y = int(x[0] * 1.3 + x[1] * 0.7 * (x[2] > 2) + rng.gauss(0, 2) > 7)
        rows.append((f"p{k}", y, *x))
    return rows


def fitted(spark, rows, tmp_path, settings=EXACT):
    df = spark.createDataFrame(rows, "user_pseudo_id string, is_churned int, a double, b double, c double")
    pipeline = churn._fit(df, COLUMNS, settings)
    model = churn.ChurnModel(pipeline, COLUMNS, {}, "v1", datetime(2024, 1, 1), {})
    path = churn.save_model(spark, model, str(tmp_path))
    return df, model, path, churn.model_nodes(spark, path)


def grown(rows, weights, targets, depth, least):
    """A regression tree by trying every cut: nested tuples, or a number for a leaf."""
    mean = sum(w * t for w, t in zip(weights, targets)) / sum(weights)

    def spread(part):
        total = sum(weights[k] for k in part)
        m = sum(weights[k] * targets[k] for k in part) / total
        return sum(weights[k] * (targets[k] - m) ** 2 for k in part)

    every = range(len(rows))
    best = None
    for f in range(len(COLUMNS)) if depth else ():
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:]):
            cut = (low + high) / 2
            left = [k for k in every if rows[k][f] <= cut]
            right = [k for k in every if rows[k][f] > cut]
            if min(len(left), len(right)) < least:
                continue
            gain = spread(every) - spread(left) - spread(right)
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                best = (gain, f, cut, left, right)
    if best is None:
        return mean
    _, f, cut, left, right = best
    below, above = (
        grown([rows[k] for k in p], [weights[k] for k in p], [targets[k] for k in p], depth - 1, least)
        for p in (left, right)
    )
    return (f, cut, below, above)


def walked(tree, x):
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def plain_scores(rows, settings):
    """Boosting with logistic loss, the first tree on the labels, later ones on the gradients."""
    xs, signs = [r[2:] for r in rows], [2.0 * r[1] - 1 for r in rows]
    positives = sum(s > 0 for s in signs)
    weight = min((len(rows) - positives) / max(positives, 1), settings.max_class_weight)
    weights = [weight if s > 0 else 1.0 for s in signs]
    total, targets = [0.0] * len(rows), signs
    for k in range(settings.n_trees):
        tree = grown(xs, weights, targets, settings.max_depth, settings.min_rows_per_leaf)
        rate = 1.0 if k == 0 else settings.learning_rate
        total = [m + rate * walked(tree, x) for m, x in zip(total, xs)]
        targets = [4 * s / (1 + math.exp(2 * s * m)) for s, m in zip(signs, total)]
    return {r[0]: 1 / (1 + math.exp(-2 * m)) for r, m in zip(rows, total)}


def test_training_equals_a_plain_search(spark, tmp_path):
    rows = players()
    df, model, path, nodes = fitted(spark, rows, tmp_path)
    scored = {r["user_pseudo_id"]: r["churn_probability"] for r in churn._probability(model.pipeline.transform(df)).collect()}
    want = plain_scores(rows, EXACT)
    assert scored.keys() == want.keys()
    assert max(abs(scored[k] - want[k]) for k in want) < 1e-9
    assert max(want.values()) - min(want.values()) > 0.5


WALK = """
WITH RECURSIVE long AS (UNPIVOT x ON a, b, c INTO NAME feature VALUE value),
walk AS (
  SELECT x.user_pseudo_id, n.* FROM x, nodes n WHERE n.node = 0
  UNION ALL
  SELECT w.user_pseudo_id, n.* FROM walk w
  JOIN long l ON l.user_pseudo_id = w.user_pseudo_id AND l.feature = w.feature
  JOIN nodes n ON n.tree = w.tree
              AND n.node = CASE WHEN l.value <= w.threshold THEN w.low ELSE w.high END
)
SELECT user_pseudo_id, 1 / (1 + exp(-2 * sum(weight * prediction))) FROM walk
WHERE feature IS NULL GROUP BY user_pseudo_id
"""


def test_scores_in_another_engine(spark, tmp_path):
    """DuckDB reads the stored nodes and walks them; sampled rows and columns, deeper trees."""
    rows = players(400, 8)
    settings = ChurnSettings(n_trees=12, max_depth=5, folds=0)
    df, model, path, nodes = fitted(spark, rows, tmp_path, settings)
    own = churn.score_players(model, df, date(2024, 1, 1))
    by_nodes = churn.score_by_nodes(churn.model_rows(model, df), nodes, COLUMNS, 5, date(2024, 1, 1), "v1")
    con = duckdb.connect()
    x = [(r[0], *r[2:]) for r in rows]
    con.execute("CREATE TABLE x (user_pseudo_id VARCHAR, a DOUBLE, b DOUBLE, c DOUBLE)")
    con.executemany("INSERT INTO x VALUES (?, ?, ?, ?)", x)
    con.execute(f"CREATE VIEW nodes AS SELECT * FROM '{path}/nodes/*.parquet'")
    walked_there = dict(con.execute(WALK).fetchall())
    for got in (own, by_nodes):
        scores = {r["user_pseudo_id"]: r["churn_probability"] for r in got.collect()}
        assert scores.keys() == walked_there.keys()
        assert max(abs(scores[k] - walked_there[k]) for k in scores) < 1e-12
    assert by_nodes.schema.names == own.schema.names
    loaded = churn.load_model(spark, path)
    assert isinstance(loaded.pipeline, PipelineModel) and loaded.columns == COLUMNS


def test_importances(spark, tmp_path):
    _, model, _, nodes = fitted(spark, players(), tmp_path)
    got = {r["feature"]: r["importance"] for r in tree_nodes.importance(nodes).collect()}
    for name, want in zip(COLUMNS, model.trees.featureImportances.toArray()):
        assert got.get(name, 0.0) == pytest.approx(want, abs=1e-9)


def test_edges(spark, tmp_path):
    """No trees, a tree of one leaf, missing values, walks that do not end, unknown features."""
    empty = spark.createDataFrame([], tree_nodes.SCHEMA)
    row = spark.createDataFrame([(None,), (1.0,), (2.0,), (float("nan"),)], "a double")

    def margins(nodes, columns=("a",), depth=1):
        return [r["m"] for r in tree_nodes.with_margin(row, nodes, columns, depth, "m").collect()]

    assert margins(empty) == [0.0] * 4
    assert tree_nodes.importance(empty).count() == 0
    leaf = [(0, 0, None, None, None, None, 2.0, 0.5, 1.0, None)]
    assert margins(spark.createDataFrame(leaf, tree_nodes.SCHEMA), depth=0) == [1.0] * 4
    split = [
        (0, 0, "a", 1.0, 1, 2, 0.0, 1.0, 4.0, 1.0),
        (0, 1, None, None, None, None, -1.0, 1.0, 2.0, None),
        (0, 2, None, None, None, None, 1.0, 1.0, 2.0, None),
    ]
    nodes = spark.createDataFrame(split, tree_nodes.SCHEMA)
    assert margins(nodes) == [1.0, -1.0, 1.0, 1.0]
    assert tree_nodes.with_margin(row.limit(0), nodes, ["a"], 1).count() == 0
    deep = spark.createDataFrame([(0, 0, "a", 1.0, 0, 0, *split[0][6:])], tree_nodes.SCHEMA)
    with pytest.raises(Exception, match="deeper than stated"):
        margins(deep, depth=3)
    other = spark.createDataFrame([(0, 0, "b", *split[0][3:]), *split[1:]], tree_nodes.SCHEMA)
    with pytest.raises(Exception, match="no column for feature"):
        margins(other)


def test_folds_are_fitted_beside_the_model(spark, monkeypatch):
    """All fits of a training are under way at once, and give what they give one after the other."""
    settings = ChurnSettings(n_trees=2, max_depth=2, folds=2)
    features = spark.createDataFrame(
        [(k, y, a, b) for k, y, a, b, _ in players()],
        "user_pseudo_id string, is_churned int, active_days double, total_events double",
    )
    together, fit = Barrier(3, timeout=60), churn._fit

    def waiting(*args):
        together.wait()
        return fit(*args)

    monkeypatch.setattr(churn, "_fit", waiting)
    model = churn.train(features, settings, trained_at=datetime(2024, 1, 30))
    monkeypatch.setattr(churn, "_fit", fit)
    monkeypatch.setattr(churn, "side_by_side", lambda spark, *steps: [step() for step in steps])
    alone = churn.train(features, settings, trained_at=datetime(2024, 1, 30))
    assert model.metrics == alone.metrics and 0 < model.metrics["cv_auc_mean"] <= 1
    assert model.trees.toDebugString.split("\n")[1:] == alone.trees.toDebugString.split("\n")[1:]
