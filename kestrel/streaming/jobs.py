"""Structured Streaming re-aims of the reference's event-at-a-time behaviour.

Every job is a pure transformation of a streaming DataFrame; ``kestrel.streaming.io``
runs it.  Event time is ``ts`` cast to TIMESTAMP (UTC session) for watermarks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.experiment import assign_variant
from kestrel.sources.adapters import DEFAULT_EXPERIMENT, event_item
from kestrel.streaming.io import CLOSING, CLOSING_USER
from kestrel.streaming.state import AlertStates, CacheEntries


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    return df.withColumn("event_time", F.col(col).cast("timestamp"))


def feedback_rows(events: DataFrame) -> DataFrame:
    """Events -> feedback rows (click / purchase = 1, view = 0); other types are not feedback."""
    fb = events.where(F.col("event_type").isin("click", "purchase", "view"))
    return fb.select("event_id", "user_id", event_item().alias("item_id"),
                     F.when(F.col("event_type") == "view", 0.0).otherwise(1.0).alias("reward"), "ts",
                     F.lit(None).cast("string").alias("variant"), F.lit(None).cast("string").alias("experiment_id"))


def ingest(fb: DataFrame) -> DataFrame:
    """Validity flag (user >= 0, item present and >= 0, reward in {0, 1}) and clicked = reward > 0."""
    ok = ((F.col("user_id") >= 0) & F.col("item_id").isNotNull() & (F.col("item_id") >= 0) &
          F.col("reward").isin(0.0, 1.0))
    return fb.withColumn("valid", F.coalesce(ok, F.lit(False))).withColumn("clicked", F.col("reward") > 0)


def enrich(fb: DataFrame, config: DataFrame, default_experiment: str = DEFAULT_EXPERIMENT) -> DataFrame:
    """Experiment defaults to ``default_experiment``; a missing variant is the hash assignment."""
    with_exp = fb.withColumn("experiment_id", F.coalesce(F.col("experiment_id"), F.lit(default_experiment)))
    assigned = assign_variant(with_exp.withColumnRenamed("variant", "_given"), config, out="_assigned")
    return assigned.withColumn("variant", F.coalesce("_given", "_assigned")).drop("_given", "_assigned")


def posterior_updates(fb: DataFrame) -> DataFrame:
    """Running successes / failures per item (update mode; associative)."""
    good = fb.where(F.col("reward").isin(0.0, 1.0))
    return good.groupBy("item_id").agg(F.sum("reward").alias("successes"), F.sum(1.0 - F.col("reward")).alias("failures"))


def ctr_windows(events: DataFrame, config: DataFrame, window: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """Exposures (views), conversions (clicks) and CTR per variant per tumbling window."""
    ev = event_time(events.where(F.col("event_type").isin("view", "click"))).withWatermark("event_time", lateness)
    ev = assign_variant(ev.withColumn("experiment_id", F.lit(DEFAULT_EXPERIMENT)), config)
    return ev.groupBy(F.window("event_time", window).alias("w"), "variant").agg(
        F.count_if(F.col("event_type") == "view").alias("exposures"),
        F.count_if(F.col("event_type") == "click").alias("conversions"))


def latency_windows(events: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                    lateness: str = "1 hour", buckets=None) -> DataFrame:
    """Sliding-window request counts, errors and cumulative latency-bucket counts (O13 input)."""
    from kestrel.operators.monitoring import LATENCY_BUCKETS
    buckets = buckets or LATENCY_BUCKETS
    ev = event_time(events).withWatermark("event_time", lateness)
    x = F.col("value") / 1000.0
    return ev.groupBy(F.window("event_time", window, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"),
        *[F.count_if(x <= le).alias(f"le{i}") for i, le in enumerate(buckets)])


def refresh_users(fb: DataFrame, ttl: str = "300 seconds", lateness: str = "1 hour") -> DataFrame:
    """One cache invalidation per user per TTL window (the first feedback time in it)."""
    ev = event_time(fb).withWatermark("event_time", lateness)
    return ev.groupBy("user_id", F.window("event_time", ttl).alias("w")).agg(F.min("ts").alias("invalidated_at"))


def cache_entries(events: DataFrame, ttl_seconds: int = 300, lateness: str = "1 hour") -> DataFrame:
    """X6 as the cache does it: every entry with its write, its end and why it ended.

    A view is a served list (it writes an entry unless one is live), clicks and purchases
    are feedback (they drop it); the lifetime counts from the last write.  Rows of other
    types only move the watermark and go no further."""
    ev = event_time(events).withWatermark("event_time", lateness)
    rows = ev.select(F.coalesce("user_id", F.lit(CLOSING_USER)).alias("user_id"), "event_id", "ts", "event_time",
                     F.when(F.col("event_type") == "view", True).when(
                         F.col("event_type").isin("click", "purchase"), False).alias("served"))
    # The event time in the condition keeps it behind the watermark, which all rows move.
    rows = rows.where(F.col("served").isNotNull() | F.col("event_time").isNull())
    return rows.groupBy("user_id").transformWithState(
        statefulProcessor=CacheEntries(ttl_seconds), outputStructType=CacheEntries.OUTPUT, outputMode="Append",
        timeMode="EventTime")


def alert_states(events: DataFrame, window_minutes: int = 5, error_thr: float = 0.05, cache_thr: float = 0.2,
                 needed: dict | None = None, lateness: str = "1 hour") -> DataFrame:
    """Transitions of the three alerts of ``monitoring.alert_windows`` over closed windows.

    ``needed``: windows in a row until an alert fires.  The windows are a partial aggregate;
    only one row per window reaches the state machines."""
    needed = needed or {"high_error": 2, "low_cache": 2, "no_traffic": 1}
    real = F.col("event_type") != CLOSING
    ev = event_time(events).withWatermark("event_time", lateness)
    g = ev.groupBy(F.window("event_time", f"{window_minutes} minutes").alias("w")).agg(
        F.count_if(real).alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"),
        F.count_if(real & (event_item() < 50)).alias("hits"), F.bool_or(~real).alias("closing"))
    holds = {"high_error": (F.col("n") > 0) & (F.col("errors") / F.col("n") > error_thr),
             "low_cache": (F.col("n") > 0) & (F.col("hits") / F.col("n") < cache_thr), "no_traffic": F.col("n") == 0}
    rows = g.select(F.window_time("w").alias("closed_at"), F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    (F.col("closing") & (F.col("n") == 0)).alias("closing"),
                    F.explode(F.array(*[F.struct(F.lit(a).alias("alert"), F.coalesce(holds[a], F.lit(False)).alias("holds"))
                                        for a in needed])).alias("x"))
    return rows.select("closed_at", "window_start", "closing", "x.alert", "x.holds").groupBy("alert").transformWithState(
        statefulProcessor=AlertStates(60 * window_minutes, needed, ("no_traffic",)), outputStructType=AlertStates.OUTPUT,
        outputMode="Append", timeMode="EventTime")


def sessions(events: DataFrame, gap: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Session windows per user (a gap longer than ``gap`` closes a session)."""
    ev = event_time(events).withWatermark("event_time", lateness)
    return ev.groupBy("user_id", F.session_window("event_time", gap).alias("s")).agg(F.count(F.lit(1)).alias("n_events"))


def dedup(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Drop replayed events (same event_id) within the watermark."""
    return event_time(events).withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["event_id"])


def _pairs(exposures: DataFrame, conversions: DataFrame, bound: str, lateness: str, how: str) -> DataFrame:
    e = event_time(exposures).withWatermark("event_time", lateness).select(
        F.col("event_id").alias("exposure_id"), F.col("user_id").alias("e_user"), F.col("ts").alias("exposure_ts"),
        F.col("event_time").alias("e_time"), F.col("variant").alias("e_variant"))
    c = event_time(conversions).withWatermark("event_time", lateness).select(
        F.col("event_id").alias("conversion_id"), F.col("user_id").alias("c_user"), F.col("ts").alias("conversion_ts"),
        F.col("event_time").alias("c_time"), F.col("variant").alias("c_variant"))
    cond = ((F.col("e_user") == F.col("c_user")) & (F.col("c_time") >= F.col("e_time")) &
            (F.col("c_time") <= F.col("e_time") + F.expr(f"INTERVAL {bound}")))
    return c.join(e, cond, how)


def attribute(exposures: DataFrame, conversions: DataFrame, bound: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Pairs of a conversion and the same user's exposures in the preceding ``bound`` (inner)."""
    return _pairs(exposures.withColumn("variant", F.lit(None).cast("string")),
                  conversions.withColumn("variant", F.lit(None).cast("string")), bound, lateness, "inner").select(
        "conversion_id", "exposure_id", F.col("c_user").alias("user_id"), "conversion_ts", "exposure_ts")


def attribute_last(exposures: DataFrame, conversions: DataFrame, bound: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Every conversion with its variant: its own, else that of the user's last exposure in the
    preceding ``bound``, else 'unknown'.

    A stream-stream left outer join: a conversion without an exposure is emitted when the
    watermarks of both sides say that none can come any more.  The last of several exposures
    is an aggregate keyed by the conversion, whose state leaves with the watermark too."""
    pairs = _pairs(exposures, conversions, bound, lateness, "left")
    last = F.max_by(F.struct("exposure_id", "exposure_ts", "e_variant"),
                    F.when(F.col("exposure_id").isNotNull(), F.struct("exposure_ts", "exposure_id")))
    keyed = pairs.groupBy("conversion_id", F.col("c_user").alias("user_id"), "conversion_ts", "c_variant", "c_time").agg(
        last.alias("l"))
    return keyed.select("conversion_id", "user_id", "conversion_ts", F.col("l.exposure_id").alias("exposure_id"),
                        F.col("l.exposure_ts").alias("exposure_ts"),
                        F.coalesce("c_variant", "l.e_variant", F.lit("unknown")).alias("variant"))
