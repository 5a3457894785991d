"""As-of merge: the newest value at or before each row, per key, as a segmented scan.

Rows are range partitioned on (key, order), so a heavy key spans as many tasks as its
rows need, and filled forward inside each (partition, key).  What crosses a partition's
border is the newest value of the key that the border cuts: one row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from kestrel.plans.ordering import _SHIFT, _num_partitions
from kestrel.session import cut_lineage


def carry_last(df: DataFrame, key: str, order_cols: list, value: str, out: str,
               num_partitions: int | None = None) -> DataFrame:
    """Append ``out``: the last non-null ``value`` of the same ``key`` up to and including each row.

    Rows that are equal in ``order_cols`` may stand in any order among themselves.
    """
    n = _num_partitions(df, num_partitions)
    stored = cut_lineage(df.repartitionByRange(n, key, *order_cols).sortWithinPartitions(key, *order_cols)
                         .withColumn("_mid", F.monotonically_increasing_id()))
    stored = stored.withColumn("_pid", F.shiftright("_mid", _SHIFT))
    # First and last key of each partition, and the newest value of that last key: one row each.
    borders = stored.groupBy("_pid").agg(F.min_by(key, "_mid").alias("_first"), F.max_by(key, "_mid").alias("_last"))
    ends = borders.select("_pid", F.col("_last").alias(key))
    newest = (stored.where(F.col(value).isNotNull()).join(F.broadcast(ends), ["_pid", key])
              .groupBy("_pid", key).agg(F.max_by(value, "_mid").alias("_end")).withColumn("_side", F.lit(1)))
    starts = borders.select("_pid", F.col("_first").alias(key), F.lit(None).cast(newest.schema["_end"].dataType).alias("_end"),
                            F.lit(0).alias("_side"))
    before = W.partitionBy(key).orderBy("_pid", "_side").rowsBetween(W.unboundedPreceding, -1)
    carried = (starts.unionByName(newest).withColumn("_carry", F.last("_end", ignorenulls=True).over(before))
               .where("_side = 0").select("_pid", key, "_carry"))
    inside = W.partitionBy("_pid", key).orderBy("_mid").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (stored.withColumn("_in", F.last(value, ignorenulls=True).over(inside))
            .join(F.broadcast(carried), ["_pid", key], "left")
            .withColumn(out, F.coalesce("_in", "_carry")).drop("_in", "_carry", "_mid", "_pid"))
