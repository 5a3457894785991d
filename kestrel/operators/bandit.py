"""Beta-Bernoulli bandit.

Posteriors are sums, hence associative: batch, incremental merge and the
streaming job all use the same aggregation.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType



def valid_rewards(fb: DataFrame, reward: str = "reward"):
    """(valid, quarantine) -- rewards outside {0, 1} (or null) go to quarantine."""
    ok = F.col(reward).isin(0, 1) & F.col(reward).isNotNull()
    return fb.where(ok), fb.where(~ok | F.col(reward).isNull())


def posterior(fb: DataFrame, item: str = "item_id", reward: str = "reward") -> DataFrame:
    """B1: alpha = 1 + sum(r), beta = 1 + sum(1 - r) per item (valid rewards only)."""
    good, _ = valid_rewards(fb, reward)
    return good.groupBy(item).agg((F.lit(1.0) + F.sum(F.col(reward).cast("double"))).alias("alpha"),
                                  (F.lit(1.0) + F.sum(F.lit(1.0) - F.col(reward).cast("double"))).alias("beta"))


def merge(state: DataFrame, batch_fb: DataFrame, item: str = "item_id", reward: str = "reward") -> DataFrame:
    """B2: add a feedback batch to stored arms; unseen items start at Beta(1, 1)."""
    good, _ = valid_rewards(batch_fb, reward)
    inc = good.groupBy(item).agg(F.sum(F.col(reward).cast("double")).alias("_s"),
                                 F.sum(F.lit(1.0) - F.col(reward).cast("double")).alias("_f"))
    j = state.select(item, "alpha", "beta").join(inc, item, "full")
    return j.select(item, (F.coalesce("alpha", F.lit(1.0)) + F.coalesce("_s", F.lit(0.0))).alias("alpha"),
                    (F.coalesce("beta", F.lit(1.0)) + F.coalesce("_f", F.lit(0.0))).alias("beta"))


def arm_stats(arms: DataFrame) -> DataFrame:
    """Trials, expected CTR, variance of Beta(alpha, beta)."""
    a, b = F.col("alpha"), F.col("beta")
    return arms.select("*", (a + b - 2).cast("bigint").alias("trials"), (a / (a + b)).alias("expected_ctr"),
                       (a * b / (F.pow(a + b, 2) * (a + b + 1))).alias("variance"))


def _uniform(state: np.ndarray, step: int) -> np.ndarray:
    """Numbers in (0, 1), the ``step``-th of each row's own sequence (a 64-bit mix of state and step)."""
    z = state + np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def _gamma(shape: np.ndarray, state: np.ndarray) -> np.ndarray:
    """One Gamma(shape, 1) draw a row: a cubed normal accepted or rejected; the rejected rows try again."""
    small = shape < 1
    d = np.where(small, shape + 1, shape) - 1.0 / 3.0
    c = 1.0 / np.sqrt(9.0 * d)
    out = np.empty(len(shape))
    open_, step = np.arange(len(shape)), 1
    while len(open_):
        s = state[open_]
        x = np.sqrt(-2.0 * np.log(_uniform(s, step))) * np.cos(2.0 * np.pi * _uniform(s, step + 1))
        v = (1.0 + c[open_] * x) ** 3
        fits = np.log(_uniform(s, step + 2)) < 0.5 * x * x + d[open_] * (1.0 - v + np.log(np.maximum(v, 1e-300)))
        ok = (v > 0) & fits
        out[open_[ok]] = (d[open_] * v)[ok]
        open_, step = open_[~ok], step + 3
    return np.where(small, out * _uniform(state, 0) ** (1.0 / shape), out)


def beta_draws(alpha: np.ndarray, beta: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """One Beta(alpha, beta) draw a row, fixed by the row's seed; a whole batch at a time."""
    state = seed.astype(np.int64).view(np.uint64)
    a, b = _gamma(alpha, state), _gamma(beta, state ^ np.uint64(0xD1B54A32D192ED03))
    return a / (a + b)


@F.pandas_udf(DoubleType())
def _beta_draw(alpha: pd.Series, beta: pd.Series, seed: pd.Series) -> pd.Series:
    return pd.Series(beta_draws(alpha.to_numpy(np.float64), beta.to_numpy(np.float64), seed.to_numpy()))


def thompson_sample(c: DataFrame, arms: DataFrame, seed: int = 42, user: str = "user_id",
                    item: str = "item_id") -> DataFrame:
    """One Beta(alpha, beta) draw per (user, item); unseen arms use Beta(1, 1).

    The numbers are mixed from xxhash64(user, item, seed), so a retried task draws
    the same ones.
    """
    j = c.join(arms.select(item, "alpha", "beta"), item, "left")
    return j.withColumn("draw", _beta_draw(F.coalesce("alpha", F.lit(1.0)), F.coalesce("beta", F.lit(1.0)),
                                           F.xxhash64(F.col(user), F.col(item), F.lit(seed))))


def rerank(c: DataFrame, arms: DataFrame, weight: float = 0.3, seed: int = 42, user: str = "user_id",
           item: str = "item_id", score: str | None = "score") -> DataFrame:
    """blended = weight * minmax(score) + (1 - weight) * draw (flat list -> 0.5);
    weight 0 or no score column -> draw only.  Returns the list re-ranked by blended score."""
    s = thompson_sample(c, arms, seed, user, item)
    if score and weight > 0:
        wu = W.partitionBy(user)
        lo, hi = F.min(score).over(wu), F.max(score).over(wu)
        norm = F.when(hi > lo, (F.col(score) - lo) / (hi - lo)).otherwise(F.lit(0.5))
        s = s.withColumn("blended", F.lit(weight) * norm + F.lit(1.0 - weight) * F.col("draw"))
    else:
        s = s.withColumn("blended", F.col("draw"))
    ranked = s.withColumn("new_rank", F.row_number().over(
        W.partitionBy(user).orderBy(F.col("blended").desc(), F.col(item).asc())).cast("bigint"))
    return ranked


def fallback_scores(c: DataFrame, user: str = "user_id", rank: str = "cand_rank", score: str = "score") -> DataFrame:
    """Keep the base score when present, else (n - i) / n by position."""
    n = F.count(F.lit(1)).over(W.partitionBy(user))
    return c.withColumn("fallback_score", F.coalesce(F.col(score), (n - (F.col(rank) - 1)) / n))


def summary(arms: DataFrame, n_items) -> DataFrame:
    """Arms, coverage %, trials total/avg/max, expected CTR avg/max/min, arms with >= 10 trials."""
    s = arm_stats(arms)
    return s.agg(F.count(F.lit(1)).alias("n_arms"), F.sum("trials").alias("total_trials"),
                 F.avg("trials").alias("avg_trials"), F.max("trials").alias("max_trials"),
                 F.avg("expected_ctr").alias("avg_ctr"), F.max("expected_ctr").alias("max_ctr"),
                 F.min("expected_ctr").alias("min_ctr"), F.count_if(F.col("trials") >= 10).alias("arms_10_plus")
                 ).withColumn("coverage_pct", F.col("n_arms") / n_items * 100.0)


def top_arms(arms: DataFrame, n: int = 20, item: str = "item_id") -> DataFrame:
    """The n arms with the highest expected CTR (item id breaks ties); a top-n report."""
    s = arm_stats(arms)
    return s.orderBy(F.col("expected_ctr").desc(), F.col(item).asc()).limit(n).withColumn(
        "rank", F.row_number().over(W.orderBy(F.col("expected_ctr").desc(), F.col(item).asc())).cast("bigint"))


def parse_arms(stored: DataFrame, item: str = "item_id") -> DataFrame:
    """alpha/beta from fields when present, else from a legacy 'alpha:beta' string; corrupt -> null."""
    parts = F.split(F.col("legacy"), ":")
    la = F.when(F.size(parts) == 2, F.expr("try_cast(split(legacy, ':')[0] as double)"))
    lb = F.when(F.size(parts) == 2, F.expr("try_cast(split(legacy, ':')[1] as double)"))
    return stored.select(item, F.coalesce(F.col("alpha_field"), la).alias("alpha"),
                         F.coalesce(F.col("beta_field"), lb).alias("beta"),
                         (F.coalesce(F.col("alpha_field"), la).isNull() | F.coalesce(F.col("beta_field"), lb).isNull())
                         .alias("corrupt"))


def learning_check(arms: DataFrame, truth: DataFrame, item: str = "item_id", tol: float = 0.10) -> DataFrame:
    """|E[CTR] - true CTR| < tol counts as learned."""
    s = arm_stats(arms).join(truth, item)
    return s.select(item, "expected_ctr", "true_ctr", F.abs(F.col("expected_ctr") - F.col("true_ctr")).alias("abs_error"),
                    (F.abs(F.col("expected_ctr") - F.col("true_ctr")) < tol).alias("learned"))
