"""Churn classifier on Spark ML: encoding, splits, boosted trees, scoring, persistence."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playerlens.functions.columns import risk_tier
from playerlens.operators import tree_nodes
from playerlens.operators.evaluation import binary_metrics
from playerlens.operators.features import FEATURE_COLUMNS, LEAKY_COLUMNS
from playerlens.operators.ranking import (
    Ordering,
    at_or_before,
    global_row_number,
    rows_at_ranks,
)
from playerlens.session import cut_lineage, side_by_side
from playerlens.settings import ChurnSettings

PLAYER = "user_pseudo_id"
LABEL = "is_churned"
CATEGORICAL = ("platform", "geo_country")
MODEL_TYPE = "gbt"


# Encoding -----------------------------------------------------------------------------------


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Codes 0.. of a column's values in alphabetical order; NULL counts as ``unknown``."""
    values = df.select(F.coalesce(column, F.lit("unknown")).alias(column)).distinct()
    numbered = global_row_number(values, [column], "_n")
    return numbered.select(column, (F.col("_n") - 1).alias(f"{column}_encoded"))


def encode(df: DataFrame, codes: DataFrame, column: str, null_as: str | None = None) -> DataFrame:
    """Adds ``<column>_encoded``; values without a code get -1.

    NULL is looked up as ``null_as`` if given (training), else it has no code (prediction). Whether
    the codes are broadcast is left to their measured size.
    """
    key = F.col(column) if null_as is None else F.coalesce(column, F.lit(null_as))
    lookup = codes.select(F.col(column).alias("_code_of"), f"{column}_encoded")
    return (
        df.join(lookup, key == F.col("_code_of"), "left")
        .withColumn(f"{column}_encoded", F.coalesce(f"{column}_encoded", F.lit(-1).cast("bigint")))
        .drop("_code_of")
    )


def encode_all(
    df: DataFrame, encoders: dict[str, DataFrame], null_as: str | None = None
) -> DataFrame:
    for column, codes in encoders.items():
        if column in df.columns:
            df = encode(df, codes, column, null_as)
    return df


# Training data ------------------------------------------------------------------------------


@dataclass
class TrainingMatrix:
    rows: DataFrame
    columns: list[str]
    missing: list[str]
    encoders: dict[str, DataFrame]


def _numeric(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]


def wanted_columns(exclude_leaky: bool = False) -> list[str]:
    kept = [c for c in FEATURE_COLUMNS if not (exclude_leaky and c in LEAKY_COLUMNS)]
    return [*kept, *[f"{c}_encoded" for c in CATEGORICAL], "is_payer_int"]


def training_matrix(features: DataFrame, exclude_leaky: bool = False) -> TrainingMatrix:
    """Player, label and numeric columns with NULL as 0; absent columns are reported."""
    present = [c for c in CATEGORICAL if c in features.columns]
    lookups = [partial(label_codes, features, c) for c in present]
    encoders = dict(zip(present, side_by_side(features.sparkSession, *lookups)))
    encoded = encode_all(features, encoders, null_as="unknown")
    if "is_payer" in features.columns:
        encoded = encoded.withColumn("is_payer_int", F.col("is_payer").cast("int"))
    wanted = wanted_columns(exclude_leaky)
    available = [c for c in wanted if c in encoded.columns]
    rows = encoded.select(PLAYER, F.col(LABEL).cast("int"), *_numeric(encoded, available))
    return TrainingMatrix(
        rows, available, [c for c in wanted if c not in encoded.columns], encoders
    )


# Splits -------------------------------------------------------------------------------------


def _shuffled(label: str, key: str, seed: int) -> list[Column]:
    """Order inside a class: pseudo-random, but the same on every run."""
    return [
        F.col(label),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key))),
        F.col(key),
    ]


def _class_sizes(df: DataFrame, label: str) -> list[tuple[int, int]]:
    """Rows per class, ascending; the label has to be binary."""
    rows = df.groupBy(label).count().orderBy(label).limit(3).collect()
    if len(rows) > 2:
        raise ValueError(f"{label} has more than two values")
    return [(r[0], r[1]) for r in rows]


def stratified_split(
    df: DataFrame, label: str = LABEL, key: str = PLAYER, fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Adds ``is_test``: the given share of each class, rounded up.

    ``df`` is read several times: pass a stored table or ``cut_lineage`` output.
    """
    order = _shuffled(label, key, seed)
    starts, cuts = 0, []
    for value, size in _class_sizes(df, label):
        held_out = -int(-size * fraction // 1)
        cuts.append((value, starts + held_out))
        starts += size
    bounds = rows_at_ranks(df, [Ordering(order)], lambda n: [rank for _, rank in cuts])[0]
    in_test = F.lit(False)
    for (value, _), bound in zip(cuts, bounds):
        in_test = in_test | ((F.col(label) == value) & at_or_before(df, order, bound))
    return df.withColumn("is_test", in_test)


def stratified_folds(
    df: DataFrame, label: str = LABEL, key: str = PLAYER, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Adds ``fold`` 0..folds-1, dealt out in turn inside each class."""
    order = [c.alias(f"_o{i}") for i, c in enumerate(_shuffled(label, key, seed))]
    ordered = df.select("*", *order)
    numbered = global_row_number(ordered, [f"_o{i}" for i in range(len(order))], "_n")
    start, before = F.lit(0), 0
    for value, size in _class_sizes(df, label):
        start = F.when(F.col(label) == value, before).otherwise(start)
        before += size
    return numbered.select(
        *df.columns, F.pmod(F.col("_n") - 1 - start, F.lit(folds)).cast("int").alias("fold")
    )


def class_weight(df: DataFrame, label: str = LABEL, most: float = 5.0) -> DataFrame:
    """Weight of a positive row in one row: negatives per positive, at most ``most``."""
    positives = F.sum(F.col(label).cast("bigint"))
    negatives = F.count(F.lit(1)) - positives
    return df.agg(
        F.least(negatives / F.greatest(positives, F.lit(1)), F.lit(most)).alias("positive_weight")
    )


# Model --------------------------------------------------------------------------------------


@dataclass
class ChurnModel:
    pipeline: PipelineModel
    columns: list[str]
    encoders: dict[str, DataFrame]
    version: str
    trained_at: datetime
    metrics: dict

    @property
    def trees(self) -> GBTClassificationModel:
        return self.pipeline.stages[-1]


def _fit(rows: DataFrame, columns: Sequence[str], settings: ChurnSettings) -> PipelineModel:
    weight = class_weight(rows, LABEL, settings.max_class_weight).scalar()
    weighted = rows.withColumn("_weight", F.when(F.col(LABEL) == 1, weight).otherwise(1.0))
    trees = GBTClassifier(
        labelCol=LABEL,
        featuresCol="features",
        weightCol="_weight",
        maxIter=settings.n_trees,
        maxDepth=settings.max_depth,
        stepSize=settings.learning_rate,
        subsamplingRate=settings.row_sampling,
        featureSubsetStrategy=settings.column_sampling,
        minInstancesPerNode=settings.min_rows_per_leaf,
        seed=settings.seed,
        checkpointInterval=10,
    )
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    return Pipeline(stages=[assembler, trees]).fit(weighted)


def _probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("churn_probability", vector_to_array("probability")[1])


def cross_validated_auc(
    rows: DataFrame, columns: Sequence[str], settings: ChurnSettings = ChurnSettings()
) -> dict[str, float]:
    """Mean and population standard deviation of the AUC over stratified folds, fitted side by side."""
    dealt = cut_lineage(stratified_folds(rows, folds=settings.folds, seed=settings.seed))
    judge = BinaryClassificationEvaluator(labelCol=LABEL, numBins=0)

    def score(k: int) -> float:
        model = _fit(dealt.filter(F.col("fold") != k), columns, settings)
        return judge.evaluate(model.transform(dealt.filter(F.col("fold") == k)))

    folds = [partial(score, k) for k in range(settings.folds)]
    scores = side_by_side(rows.sparkSession, *folds)
    mean = sum(scores) / len(scores)
    spread = (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
    return {"cv_auc_mean": mean, "cv_auc_std": spread}


def model_version(day: date) -> str:
    return day.strftime("v%Y%m%d")


def train(
    features: DataFrame,
    settings: ChurnSettings = ChurnSettings(),
    exclude_leaky: bool = False,
    trained_at: datetime | None = None,
) -> ChurnModel:
    """Fits on 80 % of the players and records metrics on the rest and over folds.

    The folds are fitted while the model is.
    """
    stamp = trained_at or datetime.now(timezone.utc).replace(tzinfo=None)
    matrix = training_matrix(features, exclude_leaky)
    rows = cut_lineage(matrix.rows)

    def fitted() -> tuple[PipelineModel, dict]:
        split = stratified_split(rows, fraction=settings.test_fraction, seed=settings.seed)
        pipeline = _fit(split.filter(~F.col("is_test")), matrix.columns, settings)
        tested = cut_lineage(
            _probability(pipeline.transform(split.filter("is_test"))).select(
                LABEL, "churn_probability"
            )
        )
        metrics = binary_metrics(tested, LABEL, "churn_probability", settings.threshold)
        return pipeline, metrics.first().asDict()

    def crossed() -> dict[str, float]:
        if settings.folds <= 1:
            return {}
        return cross_validated_auc(rows, matrix.columns, settings)

    (pipeline, found), over_folds = side_by_side(features.sparkSession, fitted, crossed)
    found.update(over_folds)
    found["missing_features"] = matrix.missing
    return ChurnModel(
        pipeline, matrix.columns, matrix.encoders, model_version(stamp.date()), stamp, found
    )


def feature_importance(model: ChurnModel, n: int = 20) -> DataFrame:
    """The ``n`` most important model columns."""
    weights = model.trees.featureImportances.toArray().tolist()
    spark = SparkSession.active()
    return (
        spark.createDataFrame(
            list(zip(model.columns, weights)), "feature STRING, importance DOUBLE"
        )
        .orderBy(F.desc("importance"), "feature")
        .limit(n)
    )


def prediction_columns(
    probability: Column, day: date, version: str, threshold: float = 0.5
) -> list[Column]:
    return [
        probability.alias("churn_probability"),
        (probability >= threshold).cast("int").alias("predicted_churn"),
        risk_tier(probability).alias("risk_tier"),
        F.lit(day).alias("prediction_date"),
        F.lit(version).alias("model_version"),
    ]


def score_players(
    model: ChurnModel, features: DataFrame, day: date, threshold: float = 0.5
) -> DataFrame:
    """Churn probability, class and risk tier of every player in ``features``."""
    scored = _probability(model.pipeline.transform(model_rows(model, features)))
    return scored.select(
        PLAYER, *prediction_columns(F.col("churn_probability"), day, model.version, threshold)
    )


def model_rows(model: ChurnModel, features: DataFrame) -> DataFrame:
    """Player and the model's numeric columns."""
    encoded = encode_all(features, model.encoders)
    if "is_payer" in features.columns:
        encoded = encoded.withColumn("is_payer_int", F.col("is_payer").cast("int"))
    return encoded.select(PLAYER, *_numeric(encoded, model.columns))


def score_by_nodes(
    rows: DataFrame,
    nodes: DataFrame,
    columns: Sequence[str],
    depth: int,
    day: date,
    version: str,
    threshold: float = 0.5,
) -> DataFrame:
    """The predictions of ``score_players`` from ``model_rows`` and a table of nodes, in SQL functions.

    For checks and for engines without Spark ML; for scoring all players the model itself is faster.
    """
    walked = tree_nodes.with_margin(rows.select(PLAYER, *columns), nodes, columns, depth)
    p = tree_nodes.probability(F.col("margin"))
    return walked.withColumn("churn_probability", p).select(
        PLAYER, *prediction_columns(F.col("churn_probability"), day, version, threshold)
    )


def model_metadata(spark: SparkSession, model: ChurnModel) -> DataFrame:
    """One row that describes a trained model."""
    found = model.metrics
    row = (
        model.version,
        MODEL_TYPE,
        model.trained_at,
        json.dumps(found, sort_keys=True),
        len(model.columns),
        *[float(found.get(m) or 0.0) for m in ("auc_roc", "f1_score", "precision", "recall")],
    )
    return spark.createDataFrame(
        [row],
        "model_version STRING, model_type STRING, trained_at TIMESTAMP, metrics_json STRING, "
        "feature_count INT, auc_roc DOUBLE, f1_score DOUBLE, precision DOUBLE, recall DOUBLE",
    )


def save_model(spark: SparkSession, model: ChurnModel, root: str) -> str:
    """Writes the model, its encoders, nodes and description below ``root/<version>``."""
    path = f"{root}/{model.version}"

    def store(df: DataFrame, part: str) -> None:
        df.write.mode("overwrite").parquet(f"{path}/{part}")

    def store_trees() -> None:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
        last = len(model.pipeline.stages) - 1
        trees = f"{path}/pipeline/stages/{last}_{model.trees.uid}"
        store(tree_nodes.stored_nodes(spark, trees, model.columns).coalesce(1), "nodes")

    encoders = [partial(store, codes, f"encoder={c}") for c, codes in model.encoders.items()]
    side_by_side(spark, store_trees, *encoders)
    # Written last: a model without a description cannot be loaded.
    described = model_metadata(spark, model).withColumn(
        "columns", F.array(*[F.lit(c) for c in model.columns])
    )
    store(described.coalesce(1), "description")
    return path


def model_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The table of nodes of a stored model; see ``tree_nodes``."""
    return spark.read.schema(tree_nodes.SCHEMA).parquet(f"{path}/nodes")


def load_model(spark: SparkSession, path: str) -> ChurnModel:
    told = spark.read.parquet(f"{path}/description").first()
    encoders = {
        c: spark.read.parquet(f"{path}/encoder={c}")
        for c in CATEGORICAL
        if f"{c}_encoded" in told["columns"]
    }
    return ChurnModel(
        PipelineModel.load(f"{path}/pipeline"),
        list(told["columns"]),
        encoders,
        told["model_version"],
        told["trained_at"],
        json.loads(told["metrics_json"]),
    )
