"""Feature quality: drift (O1-O3), validation (O5), freshness (O6), coverage (O7), health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalar import days_between

PSI_EPS = 1e-6


def _long(df: DataFrame, cols: list, side: str) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_s")
    ).select("_s.feature", "_s.v", F.lit(side).alias("side")).where(F.col("v").isNotNull())


def drift(expected: DataFrame, actual: DataFrame, cols: list, bins: int = 10) -> DataFrame:
    """Per feature: PSI over ``bins`` equal-width bins of the joint range, the normalised
    mean difference, and a status.  All features in one pass over each side.

    PSI = sum((a - e) * ln(a / e)) with e = (count + 1e-6) / (n + 1e-5); a
    constant feature has PSI 0.  Mean difference = |mean_e - mean_a| / std_pop(e)
    (or the raw difference when std < 1e-10).
    """
    both = _long(expected, cols, "e").unionByName(_long(actual, cols, "a"))
    rng = both.groupBy("feature").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    # A constant feature has no width; all its values are in bin 0.
    b = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1))
               ).otherwise(0).cast("int")
    # rng has one row per feature: bounded, broadcast is size-safe.
    binned = both.join(F.broadcast(rng), "feature").withColumn("bin", b)
    counts = binned.groupBy("feature", "side", "bin").agg(F.count(F.lit(1)).alias("c"))
    totals = both.groupBy("feature").agg(
        F.count_if(F.col("side") == "e").alias("n_e"), F.count_if(F.col("side") == "a").alias("n_a"),
        F.avg(F.when(F.col("side") == "e", F.col("v"))).alias("mean_e"),
        F.avg(F.when(F.col("side") == "a", F.col("v"))).alias("mean_a"),
        F.stddev_pop(F.when(F.col("side") == "e", F.col("v"))).alias("std_e"))
    grid = rng.select("feature", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    ce = counts.where(F.col("side") == "e").select("feature", "bin", F.col("c").alias("c_e"))
    ca = counts.where(F.col("side") == "a").select("feature", "bin", F.col("c").alias("c_a"))
    cells = (grid.join(ce, ["feature", "bin"], "left").join(ca, ["feature", "bin"], "left")
             .join(totals, "feature"))
    pe = (F.coalesce("c_e", F.lit(0)) + PSI_EPS) / (F.col("n_e") + PSI_EPS * bins)
    pa = (F.coalesce("c_a", F.lit(0)) + PSI_EPS) / (F.col("n_a") + PSI_EPS * bins)
    cells = cells.withColumn("_term", (pa - pe) * F.log(pa / pe))
    psi = cells.groupBy("feature", "lo", "hi", "mean_e", "mean_a", "std_e").agg(F.sum("_term").alias("_psi"))
    psi = psi.withColumn("psi", F.when(F.col("hi") == F.col("lo"), F.lit(0.0)).otherwise(F.col("_psi")))
    diff = F.abs(F.col("mean_e") - F.col("mean_a"))
    out = psi.select("feature", "psi", F.when(F.col("std_e") < 1e-10, diff).otherwise(F.try_divide(diff, F.col("std_e")))
                     .alias("mean_diff"))
    return out.withColumn("status", drift_status(F.col("psi")))


def drift_status(psi):
    return (F.when(psi < 0.1, F.lit("ok")).when(psi < 0.2, F.lit("slight"))
            .when(psi < 0.25, F.lit("moderate")).otherwise(F.lit("severe")))


def drift_summary(report: DataFrame) -> DataFrame:
    """Feature lists per status (O3); the lists hold feature names only (bounded)."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n_features"),
                                        F.array_join(F.array_sort(F.collect_list("feature")), ",").alias("features"))


def validate(df: DataFrame, key: str, required: list, ts: str | None = "event_timestamp") -> DataFrame:
    """Validation report rows (check, column, value, passed), computed in one aggregation.

    checks: missing_column / extra_column (schema), key_nulls, key_duplicates,
    nulls per present column, timestamp_type (TIMESTAMP or TIMESTAMP_NTZ).
    """
    spark = df.sparkSession
    present = set(df.columns)
    rows = [("missing_column", c, 1, False) for c in required if c not in present]
    rows += [("extra_column", c, 1, True) for c in df.columns if c not in required]
    if ts and ts in present:
        tname = df.schema[ts].dataType.simpleString()
        rows.append(("timestamp_type", ts, 1 if tname.startswith("timestamp") else 0,
                     tname.startswith("timestamp")))
    schema_rows = spark.createDataFrame(rows, "check string, column string, value bigint, passed boolean") if rows \
        else None
    cols = [c for c in required if c in present]
    null_aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    counts = df.agg(*null_aggs)
    nulls = counts.select(F.explode(F.array(*[
        F.struct(F.lit("nulls").alias("check"), F.lit(c).alias("column"), F.col(c).cast("bigint").alias("value"),
                 (F.col(c) == 0).alias("passed")) for c in cols])).alias("_r")).select("_r.*")
    key_nulls = df.agg(F.count_if(F.col(key).isNull()).alias("value")).select(
        F.lit("key_nulls").alias("check"), F.lit(key).alias("column"), F.col("value").cast("bigint"),
        (F.col("value") == 0).alias("passed"))
    dups = (df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("value"))
            .select(F.lit("key_duplicates").alias("check"), F.lit(key).alias("column"),
                    F.col("value").cast("bigint"), (F.col("value") == 0).alias("passed")))
    out = nulls.unionByName(key_nulls).unionByName(dups)
    return out.unionByName(schema_rows) if schema_rows is not None else out


def freshness(df: DataFrame, name: str, now, ts: str = "event_timestamp") -> DataFrame:
    """Age of the newest row against ``now``: fresh < 1 d, recent < 7 d, stale-ish < 30 d, else stale (fail)."""
    age = days_between(now, F.max(ts))
    r = df.agg(F.max(ts).alias("latest"), age.alias("age_days"))
    return r.select(F.lit(name).alias("table"), "latest", "age_days",
                    F.when(F.col("age_days") < 1, "fresh").when(F.col("age_days") < 7, "recent")
                    .when(F.col("age_days") < 30, "stale-ish").otherwise("stale").alias("status"),
                    (F.col("age_days") < 30).alias("passed"))


def coverage(probes: DataFrame, store: DataFrame, key: str, min_ratio: float = 0.6) -> DataFrame:
    """Share of probe entities present in the store; passes at >= ``min_ratio`` (3 of 5)."""
    p = probes.select(key).distinct()
    hit = p.join(store.select(key).distinct(), key, "left_semi")
    n_present = hit.select(F.count(F.lit(1))).scalar()
    both = p.agg(F.count(F.lit(1)).alias("n_probes")).withColumn("n_present", n_present)
    return both.select("n_probes", "n_present",
                       F.when(F.col("n_probes") > 0, F.col("n_present") / F.col("n_probes")).otherwise(0.0).alias("ratio"),
                       (F.when(F.col("n_probes") > 0, F.col("n_present") / F.col("n_probes")).otherwise(0.0)
                        >= min_ratio).alias("passed"))


def health(checks: DataFrame) -> DataFrame:
    """(check, passed) rows plus an ``overall`` row that passes only when every check does."""
    overall = checks.agg(F.bool_and("passed").alias("passed")).select(F.lit("overall").alias("check"), "passed")
    return checks.select("check", "passed").unionByName(overall)
