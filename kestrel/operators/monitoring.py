"""Request-log monitoring.

Quantiles are exact at every size: values are counted, and the counts summed over
range partitions.  Windowed metrics run on fixed time windows whose count depends on
the time span, not on data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from kestrel.functions.scalar import ts_to_micros
from kestrel.plans.ordering import group_quantiles

# SLA targets and latency histogram bucket bounds (seconds).
SLA_P95_MS = 200.0
SLA_ERROR_PCT = 1.0
SLA_MIN_RPS = 50.0
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0]


def latency_sla(req: DataFrame) -> DataFrame:
    """Per path plus an 'Aggregated' row: count, error %, p50/p95/p99, mean, rps and pass flags."""
    us = ts_to_micros(F.col("ts"))
    span_s = req.select(((F.max(us) - F.min(us)) / 1e6).alias("s")).scalar()
    g = req.rollup("path").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") >= 500).alias("errors"),
                               F.avg("latency_ms").alias("avg_ms"), F.grouping("path").alias("_g"))
    # One text key for the roll-up's groups: all rows, a path, the rows without a path.
    own = F.coalesce(F.concat(F.lit("path:"), F.col("path")), F.lit("none"))
    q = group_quantiles(req.select(F.explode(F.array(own, F.lit("all"))).alias("_k"), "latency_ms"), "_k", "latency_ms",
                        {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}, discrete=True)
    g = g.withColumn("_k", F.when(F.col("_g") == 1, F.lit("all")).otherwise(own)).join(q, "_k", "left")
    g = g.select(F.when(F.col("_g") == 1, F.lit("Aggregated")).otherwise(F.col("path")).alias("path"), "n", "errors",
                 (F.col("errors") / F.col("n") * 100.0).alias("error_pct"), "p50_ms", "p95_ms", "p99_ms", "avg_ms",
                 F.when(span_s > 0, F.col("n") / span_s).otherwise(F.lit(0.0)).alias("rps"))
    return g.select("*", (F.col("p95_ms") <= SLA_P95_MS).alias("p95_ok"), (F.col("error_pct") <= SLA_ERROR_PCT).alias("errors_ok"),
                    (F.col("rps") >= SLA_MIN_RPS).alias("rps_ok"))


def stage_breakdown(df: DataFrame, stage: str = "path", value: str = "latency_ms") -> DataFrame:
    """Mean per stage, share of the summed means, throughput 1000 / mean."""
    m = df.groupBy(stage).agg(F.avg(value).alias("mean_ms"))
    total = m.select(F.sum("mean_ms")).scalar()
    return m.select(stage, "mean_ms", (F.col("mean_ms") / total * 100.0).alias("pct_of_total"),
                    F.when(F.col("mean_ms") > 0, 1000.0 / F.col("mean_ms")).alias("throughput_per_s"))


def counters(req: DataFrame, variant: str = "variant") -> DataFrame:
    """Request counts by variant and outcome (error / cache_hit / success)."""
    outcome = (F.when(F.col("status") >= 500, "error").when(F.col("cached"), "cache_hit").otherwise("success"))
    return req.groupBy(variant, outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def cache_ratio(req: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """Hit ratio so far, per time bucket (running sums over the bucket table)."""
    b = req.groupBy(F.window("ts", bucket).start.alias("bucket_start")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("cached")).alias("hits"))
    w = W.orderBy("bucket_start").rowsBetween(W.unboundedPreceding, W.currentRow)  # one row per time bucket
    return b.select("bucket_start", "requests", "hits", F.sum("requests").over(w).alias("cum_requests"),
                    F.sum("hits").over(w).alias("cum_hits")).withColumn(
        "cum_hit_ratio", F.col("cum_hits") / F.col("cum_requests"))


def _hist_quantile(q: float, cums, total):
    les = F.array(*[F.lit(x) for x in LATENCY_BUCKETS])
    rank = F.lit(q) * total
    idx = F.array_position(F.transform(cums, lambda c: c >= rank), True)
    upper = F.element_at(les, idx.cast("int"))
    lower = F.when(idx > 1, F.element_at(les, (idx - 1).cast("int"))).otherwise(F.lit(0.0))
    c_hi = F.element_at(cums, idx.cast("int"))
    c_lo = F.when(idx > 1, F.element_at(cums, (idx - 1).cast("int"))).otherwise(F.lit(0))
    inside = F.when(c_hi > c_lo, lower + (upper - lower) * (rank - c_lo) / (c_hi - c_lo)).otherwise(upper)
    return F.when(total == 0, F.lit(None)).when(idx == 0, F.lit(LATENCY_BUCKETS[-1])).otherwise(inside)


def histogram_quantiles(req: DataFrame, window: str = "5 minutes", qs=(0.5, 0.95, 0.99)) -> DataFrame:
    """Prometheus-style histogram_quantile per window from cumulative bucket counts."""
    x = F.col("latency_ms") / 1000.0
    g = req.groupBy(F.window("ts", window).start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(x <= le).alias(f"_le{i}") for i, le in enumerate(LATENCY_BUCKETS)])
    cums = F.array(*[F.col(f"_le{i}") for i in range(len(LATENCY_BUCKETS))])
    return g.select("window_start", "n", *[_hist_quantile(q, cums, F.col("n")).alias(f"q{int(q * 100)}")
                                            for q in qs])


def request_rate(req: DataFrame, window: str = "5 minutes", slide: str = "1 minute", window_s: int = 300) -> DataFrame:
    """Requests and per-second rate over sliding windows."""
    g = req.groupBy(F.window("ts", window, slide).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n",
                    (F.col("n") / float(window_s)).alias("rps"))


def alert_windows(req: DataFrame, window_minutes: int = 5, error_thr: float = 0.05, cache_thr: float = 0.2) -> DataFrame:
    """Per window on a dense time grid: error rate > 5 %, no requests, hit ratio < 0.2."""
    win = f"{window_minutes} minutes"
    g = req.groupBy(F.window("ts", win).start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") >= 500).alias("errors"),
        F.count_if(F.col("cached")).alias("hits"))
    bounds = g.agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi"))
    grid = bounds.select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {window_minutes} MINUTES"))).alias("window_start"))
    j = grid.join(g, "window_start", "left").fillna(0, ["n", "errors", "hits"])
    er = F.when(F.col("n") > 0, F.col("errors") / F.col("n")).otherwise(F.lit(0.0))
    hr = F.when(F.col("n") > 0, F.col("hits") / F.col("n")).otherwise(F.lit(0.0))
    return j.select("window_start", "n", er.alias("error_rate"), hr.alias("hit_ratio"),
                    (er > error_thr).alias("high_error"), (F.col("n") == 0).alias("no_traffic"),
                    ((F.col("n") > 0) & (hr < cache_thr)).alias("low_cache"))


def sustained(windows: DataFrame, flag: str, min_windows: int) -> DataFrame:
    """Runs of consecutive windows where ``flag`` holds (gaps and islands); fired when the run
    lasts at least ``min_windows`` windows.  Runs over the time-grid table (one row per window)."""
    w_all = W.orderBy("window_start")
    w_flag = W.partitionBy(flag).orderBy("window_start")
    x = windows.select("window_start", flag, (F.row_number().over(w_all) - F.row_number().over(w_flag)).alias("_isl"))
    isl = x.where(F.col(flag)).groupBy("_isl").agg(F.min("window_start").alias("start"), F.max("window_start").alias("end"),
                                                   F.count(F.lit(1)).alias("n_windows"))
    return isl.select(F.lit(flag).alias("alert"), "start", "end", "n_windows",
                      (F.col("n_windows") >= min_windows).alias("fired"))


def feedback_polarity(fb: DataFrame, variant: str = "variant") -> DataFrame:
    """Feedback counts by variant x polarity (pivot on the two fixed polarities)."""
    pol = F.when(F.col("reward") > 0, "positive").otherwise("negative")
    return fb.withColumn("polarity", pol).groupBy(variant).pivot("polarity", ["negative", "positive"]).agg(
        F.count(F.lit(1))).fillna(0, ["negative", "positive"])


def list_diversity(lists: DataFrame, item_genres: DataFrame, variant: str = "variant", user: str = "user_id") -> DataFrame:
    """Distinct genres per recommendation list; median and mean per variant."""
    per = (lists.select(user, variant, "item_id").join(item_genres, "item_id", "left")
           .groupBy(user, variant).agg(F.count_distinct("genre").alias("n_genres")))
    per = per.withColumn("n_genres", F.col("n_genres").cast("double"))
    median = group_quantiles(per, variant, "n_genres", {"median_genres": 0.5}, discrete=True)
    g = per.groupBy(variant).agg(F.count(F.lit(1)).alias("n_lists"), F.avg("n_genres").alias("mean_genres"))
    return g.join(median, variant, "left").select(variant, "n_lists", "median_genres", "mean_genres")


def selection_concentration(selected: DataFrame, item_rank: DataFrame) -> DataFrame:
    """Selections by popularity bucket: top_100, top_1000, tail (unranked items are tail)."""
    j = selected.select("item_id").join(item_rank.select("item_id", "popularity_rank"), "item_id", "left")
    b = (F.when(F.col("popularity_rank") <= 100, "top_100").when(F.col("popularity_rank") <= 1000, "top_1000")
         .otherwise("tail"))
    return j.groupBy(b.alias("item_bucket")).agg(F.count(F.lit(1)).alias("selections"))


def increase(req: DataFrame, window: str = "24 hours") -> DataFrame:
    """O14 (increase form): total requests and errors per tumbling window."""
    g = req.groupBy(F.window("ts", window).start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status") >= 500).alias("errors"))
    return g
