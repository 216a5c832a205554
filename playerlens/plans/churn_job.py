"""Feature refresh, churn scoring and segmentation on stored tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from playerlens.operators import churn, segments
from playerlens.operators.features import feature_store, latest_snapshot
from playerlens.operators.marts import mart_player_segments
from playerlens.plans.layers import open_table, stored_path
from playerlens.session import cut_lineage, side_by_side
from playerlens.settings import Settings
from playerlens.sinks.tables import (
    append_table,
    read_table,
    rewrite_table,
    table_path,
    update_from,
    write_table,
)

PLAYER = "user_pseudo_id"


def ml_path(root: str, name: str) -> str:
    return table_path(root, "ml", name)


def refresh_features(
    spark: SparkSession, root: str, settings: Settings, computed_at: datetime
) -> int:
    features = feature_store(
        open_table(spark, root, "dim_users"),
        open_table(spark, root, "fact_sessions"),
        open_table(spark, root, "fact_events"),
        open_table(spark, root, "fact_revenue"),
        settings.ref_date,
        settings.lookback_days,
        settings.churn_after_days,
        computed_at,
    )
    return write_table(features, ml_path(root, "feature_store"))


def newest_model(spark: SparkSession, models: str) -> str | None:
    """Path of the model with the latest version, if any."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(models)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(folder):
        return None
    versions = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    dated = sorted(v for v in versions if v.startswith("v"))
    return f"{models}/{dated[-1]}" if dated else None


def update_users(spark: SparkSession, root: str) -> int:
    """Brings the player dimension up to date with the stored predictions and segments, in one write.

    The risk tier has a column of its own there; segments come from segmentation only. Players
    without a prediction or segment keep what they had.
    """
    # A player with several accounts has several rows: the highest risk, and the best segment, count.
    risk = F.max(F.struct("churn_probability", "risk_tier"))
    best = F.max_by("player_segment", F.struct("rfm_total", "player_segment"))
    predicted = read_table(spark, ml_path(root, "predictions")).groupBy(PLAYER).agg(risk.alias("risk"))
    segmented = read_table(spark, ml_path(root, "player_segments")).groupBy(PLAYER).agg(
        F.struct(best.alias("segment")).alias("best")
    )
    users = open_table(spark, root, "dim_users")
    if "risk_tier" not in users.columns:
        users = users.withColumn("risk_tier", F.lit(None).cast("string"))

    def known(part: str, value: str, own: str) -> Column:
        return F.when(F.col(f"src.{part}").isNotNull(), F.col(f"src.{part}.{value}")).otherwise(
            F.col(own)
        )

    updated = update_from(
        users,
        predicted.join(segmented, PLAYER, "full"),
        PLAYER,
        {
            "churn_probability": known("risk", "churn_probability", "churn_probability"),
            "risk_tier": F.coalesce("src.risk.risk_tier", "risk_tier"),
            "player_segment": known("best", "segment", "player_segment"),
        },
    )
    return rewrite_table(updated, stored_path(root, "dim_users"))


def churn_job(
    spark: SparkSession,
    root: str,
    mode: str = "predict",
    settings: Settings = Settings(),
    now: datetime | None = None,
) -> dict:
    """``retrain`` fits a new model; ``predict`` uses the newest one, or trains if there is none.

    Players are segmented while the model is trained and applied.
    """
    if mode not in ("predict", "retrain"):
        raise ValueError(f"unknown mode {mode!r}; one of predict, retrain")
    at = now or datetime.now(timezone.utc).replace(tzinfo=None)
    refresh_features(spark, root, settings, at)
    features = latest_snapshot(read_table(spark, ml_path(root, "feature_store")))

    def predict() -> tuple[churn.ChurnModel, str, int]:
        models = ml_path(root, "models")
        known = None if mode == "retrain" else newest_model(spark, models)
        if known is not None:
            model, done = churn.load_model(spark, known), "predict"
        else:
            model = churn.train(features, settings.churn, trained_at=at)
            churn.save_model(spark, model, models)
            done = "retrain" if mode == "retrain" else "initial_train"
        scored = churn.score_players(model, features, at.date(), settings.churn.threshold)
        predicted = write_table(scored, ml_path(root, "predictions"))
        append_table(churn.model_metadata(spark, model), ml_path(root, "model_metadata"))
        return model, done, predicted

    def segment() -> dict[str, int]:
        metrics = segments.user_metrics(read_table(spark, ml_path(root, "feature_store")))
        segmented = cut_lineage(segments.segment_players(cut_lineage(metrics)))
        write_table(segments.segment_table(segmented, at), ml_path(root, "player_segments"))
        return {r[0]: r[1] for r in segments.segment_counts(segmented).collect()}

    (model, done, predicted), counts = side_by_side(spark, predict, segment)
    update_users(spark, root)
    users = open_table(spark, root, "dim_users")
    write_table(mart_player_segments(users), stored_path(root, "mart_player_segments"))
    return {
        "mode": done,
        "model_version": model.version,
        "metrics": model.metrics,
        "predictions": predicted,
        "segments": counts,
    }
