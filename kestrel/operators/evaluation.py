"""Ranking metrics and rank-of-target computations (N7, M1-M5, M9, M11, M13 building blocks).

A rank is always 1 + (number of competing items that beat the target), so no
per-user list is ever sorted or materialised.  Ties are optimistic here (equal
scores do not beat the target); positions by vectors take ``ties`` (``vectors.target_position``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.plans.ordering import strictly_greater_count

DEFAULT_KS = (5, 10, 20)


def hit(rank, k):
    return F.when(rank <= k, F.lit(1.0)).otherwise(F.lit(0.0))


def ndcg_one(rank, k):
    return F.when(rank <= k, F.lit(1.0) / F.log2(rank.cast("double") + 1.0)).otherwise(F.lit(0.0))


def mrr(rank, k):
    return F.when(rank <= k, F.lit(1.0) / rank.cast("double")).otherwise(F.lit(0.0))


def precision(rank, k):
    return F.when(rank <= k, F.lit(1.0 / k)).otherwise(F.lit(0.0))


def metric_bundle(ranks: DataFrame, ks=DEFAULT_KS, rank_col: str = "rank", digits: int = 6) -> DataFrame:
    """One row per k: n_users, hr, ndcg, mrr, precision, mean and median rank (M1-M5).

    All k are computed in a single aggregation pass, then unpivoted.  The median is
    exact (the mean of the two middle ranks for even counts); its buffer counts
    distinct ranks, at most one entry per item of the catalogue.
    """
    r = F.col(rank_col)
    aggs = [F.count(F.lit(1)).alias("n_users"), F.avg(r.cast("double")).alias("mean_rank"),
            F.percentile(r.cast("double"), 0.5).alias("median_rank")]
    for k in ks:
        aggs += [F.avg(hit(r, k)).alias(f"hr_{k}"), F.avg(ndcg_one(r, k)).alias(f"ndcg_{k}"),
                 F.avg(mrr(r, k)).alias(f"mrr_{k}"), F.avg(precision(r, k)).alias(f"prec_{k}")]
    wide = ranks.agg(*aggs)
    stack = ", ".join(f"{k}, hr_{k}, ndcg_{k}, mrr_{k}, prec_{k}" for k in ks)
    long = wide.selectExpr("n_users", "mean_rank", "median_rank",
                           f"stack({len(ks)}, {stack}) as (k, hr, ndcg, mrr, precision)")
    return long.where(F.col("n_users") > 0).select(
        F.col("k").cast("bigint").alias("k"), "n_users",
        *[F.round(c, digits).alias(c) for c in ("hr", "ndcg", "mrr", "precision", "mean_rank", "median_rank")])


def popularity_target_rank(history: DataFrame, target: DataFrame, user: str = "user_id",
                           item: str = "item_id") -> DataFrame:
    """Rank of each user's held-out item under a most-popular recommender that skips seen items.

    rank = 1 + #items more popular than the target - #seen items more popular than the target.
    Popularity = rows per item in ``history``.  Everything is an aggregate or an
    equi-join; no user x item product is formed.
    """
    pop = history.groupBy(item).agg(F.count(F.lit(1)).alias("pop"))
    greater = strictly_greater_count(pop, "pop", "n_greater")
    n_pop_items = pop.select(F.count(F.lit(1))).scalar()
    t = (target.select(user, F.col(item).alias("target_item"))
         .join(pop.withColumnRenamed(item, "target_item"), "target_item", "left")
         .withColumn("pt", F.coalesce("pop", F.lit(0))).drop("pop"))
    t = (t.join(greater.withColumnRenamed("pop", "pt"), "pt", "left")
         .withColumn("n_greater", F.coalesce("n_greater", F.when(F.col("pt") == 0, n_pop_items).otherwise(F.lit(0)))))
    seen = (history.select(user, item).distinct()
            .join(pop, item)
            .join(t.select(user, "pt", "target_item"), user)
            .where((F.col("pop") > F.col("pt")) & (F.col(item) != F.col("target_item")))
            .groupBy(user).agg(F.count(F.lit(1)).alias("seen_greater")))
    return (t.join(seen, user, "left")
            .select(user, "target_item",
                    (F.lit(1) + F.col("n_greater") - F.coalesce("seen_greater", F.lit(0))).cast("bigint").alias("rank")))
