"""Model governance over run / version tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from kestrel.functions.scalar import days_between, sanitize_metric_name

NDCG_GATE = 0.80
MIN_GAIN = 0.01
MIN_INTERACTIONS = 100_000


def data_gate(df: DataFrame, now, min_rows: int = MIN_INTERACTIONS, user: str = "user_id", item: str = "item_id",
              ts: str = "ts") -> DataFrame:
    """Enough interactions to retrain? counts, distinct users/items, data age in whole days."""
    r = df.agg(F.count(F.lit(1)).alias("n_interactions"), F.count_distinct(user).alias("n_users"),
               F.count_distinct(item).alias("n_items"), F.max(ts).alias("latest"))
    return r.select("*", F.floor(days_between(now, F.col("latest"))).cast("bigint").alias("data_age_days"),
                    (F.col("n_interactions") >= min_rows).alias("passed"))


def promotion(runs: DataFrame, production: DataFrame, gate: float = NDCG_GATE, gain: float = MIN_GAIN) -> DataFrame:
    """A missing metric fails the run; below the NDCG@10 gate it is ``quality_gate_failed``, with or
    without a production model; then no production model, or a relative gain of at least ``gain``
    over it, promotes, and anything else is ``not_improved``."""
    p = production.select("model", F.col("ndcg_10").alias("prod_ndcg"))
    j = runs.join(p, "model", "left")
    imp = (F.col("ndcg_10") - F.col("prod_ndcg")) / F.greatest(F.col("prod_ndcg"), F.lit(1e-6))
    return j.select("run_id", "model", "ndcg_10", "prod_ndcg",
                    F.when(F.col("prod_ndcg").isNotNull(), F.round(imp * 100.0, 2)).alias("improvement_pct"),
                    F.when(F.col("ndcg_10").isNull(), "failed").when(F.col("ndcg_10") < gate, "quality_gate_failed")
                    .when(F.col("prod_ndcg").isNull() | (imp >= gain), "promoted").otherwise("not_improved")
                    .alias("status"))


def best_run(runs: DataFrame, metric: str, mode: str = "max") -> DataFrame:
    """The run with the best positive ``metric`` per model."""
    order = F.col(metric) if mode == "max" else -F.col(metric)
    r = runs.where(F.col(metric) > 0)
    return r.groupBy("model").agg(F.max_by("run_id", F.struct(order, F.col("run_id"))).alias("best_run_id"),
                                  (F.max(metric) if mode == "max" else F.min(metric)).alias(f"best_{metric}"))


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """The last n runs per model by start time (a top-n report)."""
    w = W.partitionBy("model").orderBy(F.col("start_time").desc(), F.col("run_id").desc())
    return runs.withColumn("recency", F.row_number().over(w).cast("bigint")).where(F.col("recency") <= n)


def promote_latest(versions: DataFrame) -> DataFrame:
    """The newest version of each model goes to Production; earlier Production versions are Archived."""
    newest = F.max("version").over(W.partitionBy("model"))
    return versions.select("model", "version", "stage",
                           F.when(F.col("version") == newest, "Production")
                           .when(F.col("stage") == "Production", "Archived").otherwise(F.col("stage")).alias("new_stage"))


def last_run(runs: DataFrame) -> DataFrame:
    """The newest run (max by start time)."""
    return runs.agg(F.max_by(F.struct(*runs.columns), F.struct("start_time", "run_id")).alias("_r")).select("_r.*")


def roll_up(status: DataFrame) -> DataFrame:
    """Any component down -> degraded; components ok or disabled -> healthy."""
    return status.agg(F.bool_or(F.col("status") == "down").alias("_down"), F.count(F.lit(1)).alias("n_components")).select(
        "n_components", F.when(F.col("_down"), "degraded").otherwise("healthy").alias("overall"))


def metric_names(df: DataFrame, col: str = "metric") -> DataFrame:
    """Tracking-safe metric names."""
    return df.withColumn("safe_name", sanitize_metric_name(F.col(col)))
