"""Classifier metrics against a plain count, with ties, missing values and single classes."""

import random
from itertools import product

import pytest

from playerlens.operators import evaluation

SCHEMA = "label int, p double"


def plain(rows, threshold=0.5):
    known = [(y, p) for y, p in rows if y is not None and p is not None]
    tp = sum(y == 1 and p >= threshold for y, p in known)
    fp = sum(y != 1 and p >= threshold for y, p in known)
    fn = sum(y == 1 and p < threshold for y, p in known)
    tn = len(known) - tp - fp - fn
    pairs = list(product([p for y, p in rows if y == 1], [p for y, p in rows if y == 0]))
    auc = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs) if pairs else None
    share = lambda a, b: a / b if b else None
    return {
        "auc_roc": auc,
        "precision": share(tp, tp + fp) or 0.0,
        "recall": share(tp, tp + fn) or 0.0,
        "accuracy": share(tp + tn, len(known)),
        "true_positives": tp,
        "false_positives": fp,
        "true_negatives": tn,
        "false_negatives": fn,
        "test_size": len(known),
    }


@pytest.mark.parametrize("kind", ["ties", "one class", "missing", "empty"])
def test_metrics(spark, kind):
    rng = random.Random(kind)
    rows = [(int(rng.random() < 0.3), rng.choice([0.1, 0.5, 0.5, rng.random()])) for _ in range(300)]
    if kind == "one class":
        rows = [(1, p) for _, p in rows]
    if kind == "empty":
        rows = []
    want = plain(rows)
    if kind == "missing":
        rows += [(None, 0.9), (None, 0.1)]  # only in the counts that need no label
    row = evaluation.binary_metrics(spark.createDataFrame(rows, SCHEMA), "label", "p").first()
    for name, value in want.items():
        if name == "auc_roc" and kind == "missing":
            continue
        assert row[name] == (value if value is None else pytest.approx(value)), name


def test_scores_are_read_once(spark, tmp_path):
    spark.createDataFrame([(1, 0.4), (0, 0.2)], SCHEMA).write.parquet(f"{tmp_path}/scores")
    scores = spark.read.parquet(f"{tmp_path}/scores")
    made = evaluation.binary_metrics(scores, "label", "p")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "scores" not in plan  # what is left reads the histogram
    assert made.first()["auc_roc"] == 1.0
