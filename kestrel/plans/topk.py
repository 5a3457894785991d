"""Top-k per group.

``row_number() <= k`` over ``partitionBy(keys)`` is planned by Spark as a
*partial* WindowGroupLimit before the shuffle and a final one after it, so a
heavy group ships at most k rows per map task -- the pre-aggregation we need
against skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F


def top_k(df: DataFrame, keys: list, order: list, k: int, rank_col: str = "rank") -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= k)
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def last_n(df: DataFrame, keys: list, time_cols: list, n: int, rank_col: str = "rn_desc") -> DataFrame:
    """The n most recent rows per group; ``rn_desc`` = 1 for the newest."""
    return top_k(df, keys, [F.col(c).desc() for c in time_cols], n, rank_col)
