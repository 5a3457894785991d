"""Positions and ranks without a single-partition window.

* ``global_position``: 1-based position in a total order.  The data is range
  partitioned (Spark samples the bounds), sorted inside each partition and
  numbered with ``monotonically_increasing_id``; the per-partition row counts
  (one row per partition) give the offsets.  The numbered data is written to
  the shared checkpoint folder so later reads agree even after executor loss.
* ``group_position``: 1-based position inside a group.  A heavy group spans
  several range partitions, so it is never handled by one task; the start of
  every (group, partition) slice is a tiny aggregate joined back.
* ``competition_rank`` / ``dense_rank_desc``: rank of a count among all
  counts, computed on the table of *distinct* count values (at most about
  sqrt(2 * rows) entries), then joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from kestrel.session import cut_lineage

_SHIFT = 33  # monotonically_increasing_id keeps the partition index above bit 33


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_position(df: DataFrame, order_cols: list, pos_col: str = "pos",
                    num_partitions: int | None = None, keep_pid: bool = False) -> DataFrame:
    """Append the 1-based position of each row in ``order_cols`` order.

    ``order_cols`` must be a total order (include a unique tie column) so that a
    recomputed partition numbers its rows identically.
    """
    n = _num_partitions(df, num_partitions)
    numbered = (df.repartitionByRange(n, *order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("_mid", F.monotonically_increasing_id()))
    stored = cut_lineage(numbered)
    stored = (stored.withColumn("_pid", F.shiftright("_mid", _SHIFT))
              .withColumn("_row", F.col("_mid") - F.shiftleft(F.col("_pid"), _SHIFT)))
    counts = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a bounded table, safe to order without a key.
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)),
                           F.lit(0)).alias("_off"))
    out = stored.join(F.broadcast(offsets), "_pid").withColumn(
        pos_col, (F.col("_off") + F.col("_row") + 1).cast("bigint"))
    drop = ["_mid", "_row", "_off"] + ([] if keep_pid else ["_pid"])
    return out.drop(*drop)


def group_position(df: DataFrame, keys: list, order_cols: list, pos_col: str = "pos",
                   num_partitions: int | None = None) -> DataFrame:
    """Append the 1-based position of each row inside its ``keys`` group."""
    g = global_position(df, list(keys) + list(order_cols), pos_col="_gpos",
                        num_partitions=num_partitions, keep_pid=True)
    slices = g.groupBy(*keys, "_pid").agg(F.min("_gpos").alias("_slice_start"))
    starts = slices.groupBy(*keys).agg(F.min("_slice_start").alias("_start"))
    slice_start = slices.join(starts, list(keys)).select(*keys, "_pid", "_start")
    return (g.join(slice_start, list(keys) + ["_pid"])
            .withColumn(pos_col, (F.col("_gpos") - F.col("_start") + 1).cast("bigint"))
            .drop("_gpos", "_start", "_pid"))


def competition_rank(df: DataFrame, value_col: str, rank_col: str = "rank",
                     descending: bool = True) -> DataFrame:
    """rank = 1 + number of rows with a strictly better value ("min" method)."""
    levels = df.groupBy(value_col).agg(F.count(F.lit(1)).alias("_n"))
    order = F.col(value_col).desc() if descending else F.col(value_col).asc()
    # Distinct values only -- for counts at most ~sqrt(2 * rows) of them.
    ranked = levels.select(
        value_col,
        (F.lit(1) + F.coalesce(F.sum("_n").over(W.orderBy(order).rowsBetween(W.unboundedPreceding, -1)),
                               F.lit(0))).cast("bigint").alias(rank_col))
    return df.join(ranked, value_col)


def dense_rank_desc(df: DataFrame, value_col: str, rank_col: str = "rank") -> DataFrame:
    """Dense rank of ``value_col`` (largest = 1) via the distinct-value table."""
    levels = df.select(value_col).distinct()
    ranked = levels.select(value_col, F.row_number().over(W.orderBy(F.col(value_col).desc()))
                           .cast("bigint").alias(rank_col))
    return df.join(ranked, value_col)


def strictly_greater_count(values: DataFrame, value_col: str, out_col: str = "n_greater") -> DataFrame:
    """For each distinct value v: number of rows with value > v (table of distinct values)."""
    levels = values.groupBy(value_col).agg(F.count(F.lit(1)).alias("_n"))
    return levels.select(
        value_col,
        F.coalesce(F.sum("_n").over(W.orderBy(F.col(value_col).desc()).rowsBetween(W.unboundedPreceding, -1)),
                   F.lit(0)).cast("bigint").alias(out_col))


def group_quantiles(df: DataFrame, key: str, value: str, probs: dict, discrete: bool = False) -> DataFrame:
    """Exact quantiles per group: key + one column per entry of ``probs`` (name -> p), interpolated,
    or (``discrete``) the smallest value that at least a share p of the group's values do not exceed.

    Equal values are counted first; the counts are summed over range partitions of
    (key, value), so neither a hot key nor a hot value becomes one task.  The value at
    position (n - 1) p lies between two neighbours of that order; nulls take no part.
    """
    c = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_c"))
    at = global_position(c, [key, value], pos_col="_pos", keep_pid=True)
    per = at.groupBy(key, "_pid").agg(F.sum("_c").alias("_t"))
    n = per.groupBy(key).agg(F.sum("_t").alias("_n"))
    # One row per (key, partition).
    before = per.select(key, "_pid", F.coalesce(F.sum("_t").over(
        W.partitionBy(key).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    local = F.sum("_c").over(W.partitionBy(key, "_pid").orderBy("_pos").rowsBetween(W.unboundedPreceding, W.currentRow))
    run = (at.withColumn("_hi", local).join(before, [key, "_pid"]).join(n, key)
           .withColumn("_hi", F.col("_hi") + F.col("_before")).withColumn("_lo", F.col("_hi") - F.col("_c")))
    aggs = []
    for name, p in probs.items():
        h = (F.greatest(F.ceil(F.col("_n") * F.lit(float(p))) - 1, F.lit(0)).cast("double") if discrete
             else (F.col("_n") - 1) * F.lit(float(p)))
        for side, pos in (("a", F.floor(h)), ("b", F.ceil(h))):
            held = (pos >= F.col("_lo")) & (pos < F.col("_hi"))
            aggs.append(F.max(F.when(held, F.col(value))).alias(f"_{name}_{side}"))
        aggs.append(F.max(h - F.floor(h)).alias(f"_{name}_f"))
    out = run.groupBy(key).agg(*aggs)
    return out.select(key, *[(F.col(f"_{x}_a") + (F.col(f"_{x}_b") - F.col(f"_{x}_a")) * F.col(f"_{x}_f")).alias(x)
                             for x in probs])
