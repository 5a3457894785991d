"""A/B experiments: assignment (A1-A3), attribution and variant statistics (J9, J10, A4, A5),
significance (A6-A8), report (A9), totals (A10) and session conversion (A11).

Experiment configs are a tiny table (one row per experiment); joining it is a
broadcast of a bounded table.  All data-sized work is grouping and equi-joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalar import ab_bucket_expr, format_p_value, two_sided_p

# Standard normal quantiles for alpha = 0.05 (two-sided) and power = 0.80.
Z_ALPHA_975 = 1.959963984540054
Z_POWER_80 = 0.8416212335729143
CI_Z = 1.96


def _cumulative(splits):
    return F.transform(splits, lambda x, i: F.aggregate(F.slice(splits, 1, i + 1), F.lit(0.0), lambda a, y: a + y))


def assign_variant(df: DataFrame, config: DataFrame, user: str = "user_id",
                   experiment: str = "experiment_id", out: str = "variant") -> DataFrame:
    """A1: bucket = md5("{user}:{experiment}")[:8] mod 10000 / 10000; the first cumulative split
    above the bucket wins (last variant as fallback); inactive experiments give the first variant;
    an unknown experiment raises an error."""
    cfg = config.select(F.col("experiment_id").alias("_exp"), F.col("variants").alias("_v"),
                        F.col("traffic_split").alias("_s"), F.col("is_active").alias("_a"))
    j = df.join(F.broadcast(cfg), df[experiment] == cfg["_exp"], "left")
    bucket = ab_bucket_expr(F.col(user), F.col(experiment))
    idx = F.array_position(F.transform(_cumulative(F.col("_s")), lambda b: bucket < b), True)
    chosen = (F.when(F.col("_exp").isNull(), F.raise_error(F.concat(F.lit("experiment not registered: "),
                                                                      F.col(experiment).cast("string"))))
              .when(~F.col("_a"), F.element_at("_v", 1))
              .when(idx > 0, F.element_at(F.col("_v"), idx.cast("int")))
              .otherwise(F.element_at("_v", -1)))
    cols = [c for c in df.columns if c != out]
    return j.select(*cols, chosen.cast("string").alias(out))


def variant_distribution(assigned: DataFrame, experiment: str = "experiment_id", variant: str = "variant") -> DataFrame:
    return assigned.groupBy(experiment, variant).agg(F.count(F.lit(1)).alias("n_users"))


def check_config(config: DataFrame) -> DataFrame:
    """A3: equal lengths, split sums to 1 (1e-6), every split > 0."""
    total = F.aggregate("traffic_split", F.lit(0.0), lambda a, x: a + x)
    same_len = F.size("variants") == F.size("traffic_split")
    sums = F.abs(total - 1.0) < 1e-6
    positive = F.forall("traffic_split", lambda x: x > 0)
    return config.select("experiment_id", same_len.alias("lengths_match"), sums.alias("sums_to_one"),
                         positive.alias("all_positive"), (same_len & sums & positive).alias("valid"))


def attribute_conversions(exposures: DataFrame, conversions: DataFrame, user: str = "user_id",
                          experiment: str = "experiment_id") -> DataFrame:
    """A conversion keeps its own variant, else takes the user's last exposure variant in the
    experiment, else 'unknown'.  The last exposure is a partial max-by aggregate per (user, experiment)."""
    last = exposures.groupBy(user, experiment).agg(
        F.max_by("variant", F.struct("ts", "event_id")).alias("_last_variant"))
    j = conversions.join(last, [user, experiment], "left")
    return j.withColumn("variant", F.coalesce(F.col("variant"), F.col("_last_variant"), F.lit("unknown"))).drop(
        "_last_variant")


def variant_stats(exposures: DataFrame, conversions: DataFrame, experiment_id: str | None = None) -> DataFrame:
    """A4 + A5 per (experiment, variant): counts (J10 full outer, absent -> 0), capped CTR, SE, 95 % CI."""
    if experiment_id is not None:
        exposures = exposures.where(F.col("experiment_id") == experiment_id)
        conversions = conversions.where(F.col("experiment_id") == experiment_id)
    conv = attribute_conversions(exposures, conversions)
    e = exposures.groupBy("experiment_id", "variant").agg(F.count(F.lit(1)).alias("exposures"))
    c = conv.groupBy("experiment_id", "variant").agg(F.count(F.lit(1)).alias("conversions"))
    j = e.join(c, ["experiment_id", "variant"], "full").fillna(0, ["exposures", "conversions"])
    return with_ctr(j)


def with_ctr(df: DataFrame) -> DataFrame:
    n, k = F.col("exposures"), F.col("conversions")
    eff = F.when(n > 0, F.least(k, n)).otherwise(F.lit(0))
    ctr = F.when(n > 0, eff / n).otherwise(F.lit(0.0))
    p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ctr))
    se = F.when(n > 0, F.sqrt(p * (1 - p) / n)).otherwise(F.lit(0.0))
    return df.select("*", eff.cast("bigint").alias("effective_conversions"), ctr.alias("ctr"), se.alias("std_err"),
                     F.greatest(F.lit(0.0), ctr - CI_Z * se).alias("ci_low"),
                     F.least(F.lit(1.0), ctr + CI_Z * se).alias("ci_high"))


def min_sample_size(baseline, effect: float = 0.05):
    """Per-group size to detect an absolute CTR lift of ``effect`` (alpha 0.05, power 0.8)."""
    p1 = baseline
    p2 = F.least(p1 + F.lit(effect), F.lit(0.999999))
    pb = (p1 + p2) / 2
    num = F.pow(F.lit(Z_ALPHA_975) * F.sqrt(2 * pb * (1 - pb)) + F.lit(Z_POWER_80) * F.sqrt(p1 * (1 - p1) + p2 * (1 - p2)), 2)
    den = F.pow(p2 - p1, 2)
    return F.when(den > 0, num / den).otherwise(F.lit(float("inf")))


def z_test(stats: DataFrame, config: DataFrame, level: float = 0.95) -> DataFrame:
    """A6 + A7 per experiment: control = first configured variant, treatment = second."""
    cfg = config.select("experiment_id", F.element_at("variants", 1).alias("control"),
                        F.element_at("variants", 2).alias("treatment"))
    s = stats.select("experiment_id", "variant", "exposures", "effective_conversions", "ctr")
    a = s.select("experiment_id", F.col("variant").alias("control"), F.col("exposures").alias("n_a"),
                 F.col("effective_conversions").alias("k_a"), F.col("ctr").alias("ctr_a"))
    b = s.select("experiment_id", F.col("variant").alias("treatment"), F.col("exposures").alias("n_b"),
                 F.col("effective_conversions").alias("k_b"), F.col("ctr").alias("ctr_b"))
    j = F.broadcast(cfg).join(a, ["experiment_id", "control"], "left").join(b, ["experiment_id", "treatment"], "left")
    j = j.fillna(0, ["n_a", "k_a", "n_b", "k_b"]).fillna(0.0, ["ctr_a", "ctr_b"])
    tot = F.col("n_a") + F.col("n_b")
    pool = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("k_a") + F.col("k_b")) / tot))
    se = F.sqrt(pool * (1 - pool) * (F.lit(1.0) / F.col("n_a") + F.lit(1.0) / F.col("n_b")))
    valid = (F.col("n_a") > 0) & (F.col("n_b") > 0)
    z = F.when(valid & (se >= 1e-10), (F.col("ctr_b") - F.col("ctr_a")) / se).otherwise(F.lit(0.0))
    j = j.where(tot > 0).withColumn("z", z)
    p = F.when(valid & (se >= 1e-10), two_sided_p(F.col("z"))).otherwise(F.lit(1.0))
    j = j.withColumn("p_value", p)
    rel = F.when(F.col("ctr_a") > 0, (F.col("ctr_b") - F.col("ctr_a")) / F.col("ctr_a") * 100.0).otherwise(F.lit(0.0))
    sig = F.col("p_value") < F.lit(1.0 - level)
    j = j.select("experiment_id", "control", "treatment", "n_a", "k_a", "n_b", "k_b", "ctr_a", "ctr_b", "z",
                 "p_value", rel.alias("relative_lift_pct"), (F.col("ctr_b") - F.col("ctr_a")).alias("absolute_lift"),
                 sig.alias("is_significant"))
    return j.select("*", format_p_value(F.col("p_value")).alias("p_value_text"),
                    F.when(~F.col("is_significant"), "collect_more_data")
                    .when(F.col("relative_lift_pct") > 0, "deploy_treatment").otherwise("keep_control").alias("decision"),
                    min_sample_size(F.col("ctr_a")).alias("min_sample_size"))


def report(config: DataFrame, stats: DataFrame, tests: DataFrame) -> DataFrame:
    """Every configured variant (absent -> 0), uncapped CTR, winner = highest CTR unless the
    test is significant (then treatment on positive lift, else control)."""
    v = config.select("experiment_id", F.posexplode("variants").alias("variant_order", "variant"))
    s = stats.select("experiment_id", "variant", "exposures", "conversions", "ci_low", "ci_high")
    rows = v.join(s, ["experiment_id", "variant"], "left").fillna(0, ["exposures", "conversions"]).fillna(
        0.0, ["ci_low", "ci_high"])
    rows = rows.withColumn("ctr", F.when(F.col("exposures") > 0, F.col("conversions") / F.col("exposures"))
                           .otherwise(F.lit(0.0)))
    best = rows.groupBy("experiment_id").agg(
        F.max_by("variant", F.struct(F.col("ctr"), -F.col("variant_order"))).alias("_best"))
    t = tests.select("experiment_id", "control", "treatment", "z", "p_value", "is_significant", "relative_lift_pct")
    w = best.join(t, "experiment_id", "left").select(
        "experiment_id", F.coalesce("z", F.lit(0.0)).alias("z"), F.coalesce("p_value", F.lit(1.0)).alias("p_value"),
        F.coalesce("is_significant", F.lit(False)).alias("is_significant"),
        F.when(F.col("is_significant"), F.when(F.col("relative_lift_pct") > 0, F.col("treatment"))
               .otherwise(F.col("control"))).otherwise(F.col("_best")).alias("winner"))
    return rows.join(w, "experiment_id", "left")


def totals(df: DataFrame, experiment_id: str | None = None) -> DataFrame:
    """A10: row count, optionally for one experiment."""
    if experiment_id is not None:
        df = df.where(F.col("experiment_id") == experiment_id)
    return df.agg(F.count(F.lit(1)).alias("n"))


def session_conversion(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Per variant, sessions with at least one exposure and whether any conversion happened
    in them (at most one conversion counted per session)."""
    per = events.join(sessions, ["user_id", "session_start"]).groupBy("variant", "user_id", "session_start").agg(
        F.max(F.col("is_conversion").cast("int")).alias("converted"), F.max(F.col("is_exposure").cast("int")).alias("_e"))
    per = per.where(F.col("_e") == 1)
    return per.groupBy("variant").agg(F.count(F.lit(1)).alias("sessions"), F.sum("converted").alias("converted"),
                                      F.avg(F.col("converted").cast("double")).alias("session_ctr"))
