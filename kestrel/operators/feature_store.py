"""Feature-store operators: point-in-time join (J5), latest per key (J6), entity lookup.

The as-of join is a segmented scan (``plans/asof.py``): facts and features are
range partitioned on (entity, time), filled forward inside each partition, and
the newest feature row of an entity is carried over the border that cuts it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalar import ts_to_micros
from kestrel.plans.asof import carry_last

# Defaults for entities missing from the store.
USER_DEFAULTS = {
    "avg_rating": 3.5, "total_interactions": 0.0, "rating_std": 0.5, "min_rating": 1.0, "max_rating": 5.0,
    "high_rating_ratio": 0.5, "active_days": 1.0, "interaction_density": 1.0, "temporal_spread_days": 0.0,
    "recency_days": 365.0, "session_count": 1.0, "avg_session_length": 1.0, "genre_diversity": 5.0,
    "top_genre_idx": 4.0, "popularity_bias": 5000.0,
}
ITEM_DEFAULTS = {
    "global_popularity": 0.0, "popularity_rank": 99999.0, "niche_score": 1.0, "avg_ratings_per_day": 0.0,
    "avg_item_rating": 3.0, "rating_count": 0.0, "rating_std": 0.5, "high_rating_ratio": 0.5,
    "genre_count": 1.0, "primary_genre_idx": 7.0, "release_year": 2000.0, "item_age_days": 8760.0,
}


def pit_join(facts: DataFrame, features: DataFrame, key: str, feature_cols: list,
             fact_ts: str = "ts", feature_ts: str = "event_timestamp", ttl_seconds: int = 30 * 86400,
             fill=0, num_partitions: int | None = None) -> DataFrame:
    """For every fact row: the newest feature row of the same key with
    ``feature_ts <= fact_ts`` and ``feature_ts >= fact_ts - ttl``; absent -> ``fill``.

    Returns the fact columns, ``feature_ts`` of the match (null when none) and
    the feature columns.  A null key or time matches nothing.
    """
    payload = F.struct(F.col(feature_ts).alias("_fts"), *[F.col(c) for c in feature_cols])
    others = [c for c in facts.columns if c not in (key, fact_ts)]
    feats = (features.where(F.col(key).isNotNull() & F.col(feature_ts).isNotNull())
             .select(key, F.col(feature_ts).alias("_t"), F.lit(0).alias("_tag"), payload.alias("_p"),
                     *[F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in others]))
    asked = facts.select(key, F.col(fact_ts).alias("_t"), F.lit(1).alias("_tag"),
                         F.lit(None).cast(feats.schema["_p"].dataType).alias("_p"), *others)
    # Features stand before facts of the same time (<=).
    found = carry_last(feats.unionByName(asked), key, ["_t", "_tag", "_p"], "_p", "_m", num_partitions).where("_tag = 1")
    ttl_us = F.lit(ttl_seconds * 1_000_000)
    ok = F.col("_m._fts").isNotNull() & (ts_to_micros(F.col("_m._fts")) >= ts_to_micros(F.col("_t")) - ttl_us)
    out = found.select(
        key, *others, F.col("_t").alias(fact_ts), F.when(ok, F.col("_m._fts")).alias(feature_ts),
        *[F.when(ok, F.col(f"_m.{c}")).alias(c) for c in feature_cols])
    if fill is not None:
        out = out.fillna(fill, subset=feature_cols)
    return out.select(*facts.columns, feature_ts, *feature_cols)


def materialize_latest(df: DataFrame, key: str, start=None, end=None, ts: str = "event_timestamp") -> DataFrame:
    """Newest row per key with ``start <= ts <= end`` (defaults: [min - 1 day, max + 1 s]).

    A partial aggregation (max of a struct led by the timestamp), so heavy keys
    are reduced before the shuffle.
    """
    if start is None:
        start = df.select(F.min(ts)).scalar() - F.expr("INTERVAL 1 DAY")
    if end is None:
        end = df.select(F.max(ts)).scalar() + F.expr("INTERVAL 1 SECOND")
    others = [c for c in df.columns if c not in (key, ts)]
    win = df.where((F.col(ts) >= start) & (F.col(ts) <= end))
    latest = win.groupBy(key).agg(F.max(F.struct(F.col(ts), *[F.col(c) for c in others])).alias("_r"))
    return latest.select(key, *[F.col(f"_r.{c}").alias(c) for c in [ts] + others])


def entity_lookup(requests: DataFrame, store: DataFrame, key: str, defaults: dict) -> DataFrame:
    """Features by key for every request row; absent entities get ``defaults`` (and found = false)."""
    cols = list(defaults)
    s = store.select(key, *[F.col(c).cast("double").alias(c) for c in cols]).withColumn("_found", F.lit(True))
    out = requests.join(s, key, "left")
    return out.select(*requests.columns, F.coalesce("_found", F.lit(False)).alias("found"),
                      *[F.coalesce(F.col(c), F.lit(float(v))).alias(c) for c, v in defaults.items()])
