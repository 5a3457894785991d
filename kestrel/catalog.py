"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads whole driver tables through ``kestrel.sources.adapters``.
Column names match ``kestrel.oracle_sql.ORACLE``.
"""

from __future__ import annotations

from kestrel.sources import adapters as A
from kestrel.operators import prep, evaluation
from kestrel.session import cut_lineage

QUERIES = {}


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def implicit_core(spark, sf):
    return prep.k_core(A.ratings(spark, sf, min_rating=4.0))


@register("popularity_eval")
def popularity_eval(spark, sf):
    history, target = prep.holdout_last(implicit_core(spark, sf))
    ranks = evaluation.popularity_target_rank(history, target)
    return evaluation.metric_bundle(ranks)


# ---- step 1: preparation ------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402


@register("k_core")
def q_k_core(spark, sf):
    return implicit_core(spark, sf).select("user_id", "item_id", "rating", "ts", "tie")


@register("dense_encode")
def q_dense_encode(spark, sf):
    core = implicit_core(spark, sf)
    users = prep.dense_encode(core, "user_id", "idx").select(F.lit("user").alias("kind"),
                                                             F.col("user_id").alias("raw_id"), "idx")
    items = prep.dense_encode(core, "item_id", "idx").select(F.lit("item").alias("kind"),
                                                             F.col("item_id").alias("raw_id"), "idx")
    return users.unionByName(items)


@register("dataset_stats")
def q_dataset_stats(spark, sf):
    return prep.dataset_stats(implicit_core(spark, sf))


@register("sequences_padded")
def q_sequences_padded(spark, sf):
    s = prep.padded_sequences(implicit_core(spark, sf), length=50)
    return s.select("user_id", F.array_join(F.col("seq").cast("array<string>"), ",").alias("seq"), "n_recent")


@register("sequence_positions")
def q_sequence_positions(spark, sf):
    return prep.sequence_positions(implicit_core(spark, sf)).select("user_id", "pos", "item_id", "ts")


@register("leave_last_out")
def q_leave_last_out(spark, sf):
    train, val, test = prep.leave_last_out(implicit_core(spark, sf))
    cols = ["user_id", "item_id", "ts", "tie"]
    return (train.select(F.lit("train").alias("split"), *cols)
            .unionByName(val.select(F.lit("val").alias("split"), *cols))
            .unionByName(test.select(F.lit("test").alias("split"), *cols)))


@register("serving_history")
def q_serving_history(spark, sf):
    return prep.serving_history(implicit_core(spark, sf)).select("user_id", "item_id", "ts", "tie")


@register("next_item_pairs")
def q_next_item_pairs(spark, sf):
    return prep.next_item_pairs(implicit_core(spark, sf), length=50)


@register("prefix_samples")
def q_prefix_samples(spark, sf):
    return prep.prefix_samples(implicit_core(spark, sf), max_len=50)


@register("train_window")
def q_train_window(spark, sf):
    return prep.train_window(implicit_core(spark, sf), A.ratings(spark, sf))


@register("user_item_sets")
def q_user_item_sets(spark, sf):
    return prep.user_item_sets(implicit_core(spark, sf))


@register("recent_history")
def q_recent_history(spark, sf):
    return prep.recent_history(implicit_core(spark, sf), A.items(spark, sf), n=10)


@register("vocab_filter_binarize")
def q_vocab_filter(spark, sf):
    """Raw implicit ratings restricted to ids present in the k-core maps, with interaction = 1."""
    core = implicit_core(spark, sf)
    raw = A.ratings(spark, sf, min_rating=4.0)
    kept = prep.vocab_filter(prep.vocab_filter(raw, core.select("user_id").distinct(), "user_id"),
                             core.select("item_id").distinct(), "item_id")
    return prep.binarize(kept).select("user_id", "item_id", "ts", "tie", "interaction")


# ---- step 2: features -------------------------------------------------------------------
from pyspark.sql import types as T  # noqa: E402
from kestrel.operators import features as feat  # noqa: E402


def round_doubles(df, digits=6):
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def user_map(spark, sf):
    return prep.dense_encode(implicit_core(spark, sf), "user_id", "user_idx")


def item_map(spark, sf):
    return prep.dense_encode(implicit_core(spark, sf), "item_id", "item_idx")


@register("user_features_full")
def q_user_features_full(spark, sf):
    uf = feat.user_features(A.ratings(spark, sf, min_rating=4.0), A.items(spark, sf), A.genre_vocab(spark, sf),
                            idmap=user_map(spark, sf))
    return round_doubles(uf)


@register("user_sessions")
def q_user_sessions(spark, sf):
    ev = A.table(spark, sf, "events").select("user_id", "ts")
    return feat.session_stats(ev, gap_s=3600)


@register("item_features")
def q_item_features(spark, sf):
    itf = feat.item_features(A.ratings(spark, sf), A.items(spark, sf), A.genre_vocab(spark, sf),
                             idmap=item_map(spark, sf))
    return round_doubles(itf)


@register("item_popularity_rank")
def q_item_popularity_rank(spark, sf):
    from kestrel.plans.ordering import competition_rank
    counts = A.ratings(spark, sf, min_rating=4.0).groupBy("item_id").agg(F.count(F.lit(1)).alias("global_popularity"))
    return competition_rank(counts, "global_popularity", "popularity_rank").select(
        "item_id", "global_popularity", "popularity_rank")


def _train_ratings(spark, sf):
    return prep.train_window(implicit_core(spark, sf), A.ratings(spark, sf))


@register("rank_user_features")
def q_rank_user_features(spark, sf):
    tw = _train_ratings(spark, sf)
    lens = tw.groupBy("user_id").agg(F.count(F.lit(1)).alias("user_sequence_length"))
    return round_doubles(feat.rank_user_features(tw, lens))


@register("rank_item_features")
def q_rank_item_features(spark, sf):
    return round_doubles(feat.rank_item_features(_train_ratings(spark, sf), A.items(spark, sf)))


@register("genre_onehot")
def q_genre_onehot(spark, sf):
    return feat.genre_onehot(A.items(spark, sf))


@register("popularity_distribution")
def q_popularity_distribution(spark, sf):
    return round_doubles(feat.popularity_distribution(implicit_core(spark, sf)))


USER_FEATURE_COLS = ["avg_rating", "total_interactions", "rating_std", "min_rating", "max_rating",
                     "high_rating_ratio", "temporal_spread_days", "recency_days", "active_days",
                     "interaction_density", "genre_diversity", "top_genre_idx", "session_count",
                     "avg_session_length", "popularity_bias"]


@register("feature_summary")
def q_feature_summary(spark, sf):
    uf = feat.user_features(A.ratings(spark, sf, min_rating=4.0), A.items(spark, sf), A.genre_vocab(spark, sf))
    return feat.describe(round_doubles(uf), USER_FEATURE_COLS)


# ---- step 3: feature store -------------------------------------------------------------------
from kestrel.operators import feature_store as fs, quality  # noqa: E402
from kestrel.functions.scalar import ts_to_micros  # noqa: E402

SNAP_COLS = ["cum_events", "cum_clicks", "cum_purchases", "cum_value"]


def _facts(spark, sf):
    return A.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")


@register("pit_join")
def q_pit_join(spark, sf):
    return fs.pit_join(_facts(spark, sf), A.snapshots(spark, sf), "user_id", SNAP_COLS, ttl_seconds=30 * 86400)


@register("pit_join_ttl_1d")
def q_pit_join_ttl(spark, sf):
    return fs.pit_join(_facts(spark, sf), A.snapshots(spark, sf), "user_id", SNAP_COLS, ttl_seconds=86400)


def _item_facts(spark, sf):
    return A.table(spark, sf, "events").select("event_id", "user_id", A.event_item().alias("item_id"), "ts")


@register("pit_join_items")
def q_pit_join_items(spark, sf):
    """J5, item view: the item's counters as they stood at each event."""
    return fs.pit_join(_item_facts(spark, sf), A.item_snapshots(spark, sf), "item_id", SNAP_COLS, ttl_seconds=30 * 86400)


@register("pit_training_rows")
def q_pit_training_rows(spark, sf):
    """J5, both views on the same rows: label = click or purchase, user and item counters before it."""
    rows = A.feedback(spark, sf).select("event_id", "user_id", "item_id", "ts", F.col("reward").cast("int").alias("label"))
    users = A.snapshots(spark, sf).withColumnsRenamed({c: f"user_{c}" for c in SNAP_COLS})
    items = A.item_snapshots(spark, sf).withColumnsRenamed({c: f"item_{c}" for c in SNAP_COLS})
    rows = fs.pit_join(rows, users, "user_id", [f"user_{c}" for c in SNAP_COLS]).drop("event_timestamp")
    return fs.pit_join(rows, items, "item_id", [f"item_{c}" for c in SNAP_COLS]).drop("event_timestamp")


@register("materialize_latest")
def q_materialize_latest(spark, sf):
    return fs.materialize_latest(A.snapshots(spark, sf), "user_id")


def _user_store(spark, sf):
    return feat.user_features(A.ratings(spark, sf, min_rating=4.0), A.items(spark, sf), A.genre_vocab(spark, sf))


@register("entity_lookup_defaults")
def q_entity_lookup(spark, sf):
    req = A.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return round_doubles(fs.entity_lookup(req, _user_store(spark, sf), "user_id", fs.USER_DEFAULTS))


def _halves(spark, sf):
    snaps = A.snapshots(spark, sf)
    us = ts_to_micros(F.col("event_timestamp"))
    bounds = snaps.agg(F.min(us).alias("lo"), F.max(us).alias("hi"))
    cut = bounds.select(F.expr("(lo + hi) div 2")).scalar()
    return snaps.where(us < cut), snaps.where(us >= cut)


@register("psi_skew")
def q_psi_skew(spark, sf):
    e, a = _halves(spark, sf)
    return round_doubles(quality.drift(e, a, SNAP_COLS))


@register("drift_summary")
def q_drift_summary(spark, sf):
    e, a = _halves(spark, sf)
    return quality.drift_summary(quality.drift(e, a, SNAP_COLS))


USER_STORE_REQUIRED = ["user_idx", "event_timestamp"] + USER_FEATURE_COLS


@register("validate_table")
def q_validate_table(spark, sf):
    uf = feat.user_features(A.ratings(spark, sf, min_rating=4.0), A.items(spark, sf), A.genre_vocab(spark, sf),
                            idmap=user_map(spark, sf))
    return quality.validate(uf, "user_idx", USER_STORE_REQUIRED)


def _now(spark, sf):
    return A.table(spark, sf, "events").select(F.max("ts")).scalar()


@register("freshness")
def q_freshness(spark, sf):
    now = _now(spark, sf)
    return round_doubles(quality.freshness(A.snapshots(spark, sf), "snapshots", now).unionByName(
        quality.freshness(_user_store(spark, sf), "user_features", now)))


@register("coverage")
def q_coverage(spark, sf):
    probes = A.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return round_doubles(quality.coverage(probes, fs.materialize_latest(A.snapshots(spark, sf), "user_id"), "user_id"))


@register("health_summary")
def q_health_summary(spark, sf):
    now = _now(spark, sf)
    fresh = quality.freshness(A.snapshots(spark, sf), "snapshots", now).select(
        F.concat(F.lit("freshness:"), F.col("table")).alias("check"), "passed")
    probes = A.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    cov = quality.coverage(probes, A.snapshots(spark, sf), "user_id").select(F.lit("coverage").alias("check"), "passed")
    val = (quality.validate(A.snapshots(spark, sf), "user_id", ["user_id", "event_timestamp"] + SNAP_COLS)
           .where(F.col("check") != "key_duplicates")
           .agg(F.bool_and("passed").alias("passed")).select(F.lit("validation").alias("check"), "passed"))
    return quality.health(fresh.unionByName(cov).unionByName(val))


# ---- step 4: retrieval -----------------------------------------------------------------------
from kestrel.operators import vectors as vx  # noqa: E402


def _vectors(spark, sf):
    return A.vectors(spark, sf).select("item_id", "vec")


def _event_items(spark, sf):
    """(user_id, item_id, ts, tie) from click / purchase / view events, item = props.k."""
    return A.feedback(spark, sf).select("user_id", "item_id", "ts", F.col("event_id").alias("tie"))


@register("vector_checks")
def q_vector_checks(spark, sf):
    v = _vectors(spark, sf)
    raw = vx.norm_stats(v)
    fixed = vx.scrub(v)
    after = fixed.agg(F.sum("n_fixed").alias("n_fixed"),
                      F.avg(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).alias("norm_mean_after"))
    return round_doubles(raw.select("*", after.select("n_fixed").scalar().alias("n_fixed"),
                                    after.select("norm_mean_after").scalar().alias("norm_mean_after")))


@register("vector_topk")
def q_vector_topk(spark, sf):
    v = _vectors(spark, sf)
    return round_doubles(vx.topk_inner_product(v.withColumnRenamed("item_id", "qid"), v, k=10))


@register("similar_items")
def q_similar_items(spark, sf):
    return round_doubles(vx.similar_items(_vectors(spark, sf), k=10))


def _user_vectors(spark, sf, history=None):
    h = history if history is not None else _event_items(spark, sf)
    return vx.pool_history(h, _vectors(spark, sf))


@register("user_vectors")
def q_user_vectors(spark, sf):
    u = _user_vectors(spark, sf)
    return round_doubles(u.select("user_id", F.posexplode("vec").alias("d", "v"))
                         .select("user_id", F.col("d").cast("bigint").alias("d"), "v"))


@register("topk_exclude_seen")
def q_topk_exclude_seen(spark, sf):
    seen = _event_items(spark, sf)
    return round_doubles(vx.topk_excluding(_user_vectors(spark, sf), _vectors(spark, sf), seen, k=10))


@register("recall_at_k")
def q_recall_at_k(spark, sf):
    ev = _event_items(spark, sf)
    history, target = prep.holdout_last(ev)
    q = _user_vectors(spark, sf, history).join(target.select("user_id", F.col("item_id").alias("target_id")), "user_id")
    pos = vx.target_position(q.withColumnRenamed("user_id", "qid"), _vectors(spark, sf))
    ks = [10, 50, 100, 200]
    wide = pos.agg(F.count(F.lit(1)).alias("n_users"),
                   *[F.avg(F.when(F.col("position") <= k, 1.0).otherwise(0.0)).alias(f"r{k}") for k in ks])
    long = wide.selectExpr("n_users", "stack(4, " + ", ".join(f"{k}, r{k}" for k in ks) + ") as (k, recall)")
    return round_doubles(long.select(F.col("k").cast("bigint").alias("k"), "n_users", "recall"))


@register("vector_collapse")
def q_vector_collapse(spark, sf):
    return round_doubles(vx.collapse(_user_vectors(spark, sf)))


@register("pair_scores")
def q_pair_scores(spark, sf):
    pairs = A.feedback(spark, sf).where(F.col("reward") > 0).select("event_id", "user_id", "item_id")
    return round_doubles(vx.pair_scores(pairs, _user_vectors(spark, sf), _vectors(spark, sf)))


@register("seed_resolution")
def q_seed_resolution(spark, sf):
    req = A.table(spark, sf, "part").select(F.col("p_partkey").alias("seed_id"))
    return vx.resolve_seed(req, _vectors(spark, sf))


# ---- step 5: ranking set -----------------------------------------------------------------------------
from kestrel.operators import ranking as rk  # noqa: E402
from kestrel.functions.scalar import sigmoid  # noqa: E402


def _event_inter(spark, sf):
    """Events-space interactions with the feedback reward as rating."""
    return A.feedback(spark, sf).select("user_id", "item_id", F.col("reward").alias("rating"), "ts",
                                        F.col("event_id").alias("tie"))


def _candidate_set(spark, sf, n=100, inject=True):
    """``inject``: users whose missing held-out item joins their list; all, or those a condition names."""
    # Each feeds several branches below and in the callers: parsed, split and scored once.
    history, target = prep.holdout_last(cut_lineage(_event_inter(spark, sf)))
    history, target = cut_lineage(history), cut_lineage(target)
    vec = _vectors(spark, sf)
    users = cut_lineage(vx.pool_history(history, vec))
    cands = cut_lineage(vx.topk_excluding(users, vec, history, k=n).withColumnRenamed("rank", "cand_rank"))
    cands = rk.inject_positive(cands, target.where(F.lit(inject)))
    return rk.label(cands, target), history, target


@register("candidate_set")
def q_candidate_set(spark, sf):
    c, _, _ = _candidate_set(spark, sf)
    return round_doubles(c)


@register("retrieval_features")
def q_retrieval_features(spark, sf):
    c, _, _ = _candidate_set(spark, sf)
    return round_doubles(rk.retrieval_features(c))


def _genre_tables(spark, sf):
    items = A.items(spark, sf)
    oh = feat.item_genres_long(items)
    ig = feat.item_genre_rows(items, A.genre_vocab(spark, sf))
    primary = ig.groupBy("item_id").agg(F.min_by("idx", "pos").alias("primary_genre_idx"))
    return oh, ig.select("item_id", "genre"), primary


@register("genre_overlap")
def q_genre_overlap(spark, sf):
    c, history, _ = _candidate_set(spark, sf)
    oh, ig, primary = _genre_tables(spark, sf)
    out = rk.genre_overlap(c, rk.genre_preferences(history, oh), oh)
    out = rk.online_overlap(out, history, ig, last=50)
    out = rk.primary_genre_overlap(out, history, primary)
    return round_doubles(out.select("user_id", "cand_rank", "item_id", "genre_overlap", "genre_max_match",
                                    "online_overlap", "is_same_top_genre", "primary_genre_overlap"))


# The 45 training columns, by family, and the declared genres of the model's schema.
GENRES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"] + [f"Brand#{i}" for i in range(1, 14)]
RANK_USER_COLS = ["user_rating_count", "user_avg_rating", "user_min_rating", "user_max_rating", "user_rating_std",
                  "user_active_days", "user_days_since_last", "user_sequence_length"]
RANK_ITEM_COLS = ["item_rating_count", "item_avg_rating", "item_rating_std", "item_popularity", "item_log_popularity",
                  "item_days_since_last_rating", "item_active_days", "item_year", "item_num_genres",
                  "item_popularity_rank"]
RANK_LIST_COLS = ["score", "cand_rank", "rank_norm", "score_norm", "score_gap"]
RANK_PAIR_COLS = ["genre_overlap", "genre_max_match", "item_popularity_pct"]
RANK_GENRE_COLS = [feat.genre_name(g) for g in GENRES]
RANK_FEATURES = RANK_USER_COLS + RANK_ITEM_COLS + RANK_GENRE_COLS + RANK_LIST_COLS + RANK_PAIR_COLS


def _ranking_matrix(spark, sf, inject=True):
    c, history, _ = _candidate_set(spark, sf, inject=inject)
    # The candidates and their genres feed several branches below: each is computed once.
    c = cut_lineage(c)
    items = A.items(spark, sf)
    oh = cut_lineage(feat.item_genres_long(items))
    lens = history.groupBy("user_id").agg(F.count(F.lit(1)).alias("user_sequence_length"))
    uf = feat.rank_user_features(history, lens).select("user_id", *RANK_USER_COLS)
    itf = feat.rank_item_features(history, items, oh).select("item_id", *RANK_ITEM_COLS)
    max_cnt = itf.select(F.max("item_rating_count")).scalar()
    itf = itf.join(feat.genre_wide(oh, GENRES), "item_id", "left")
    # What hangs on the item first, then what hangs on the user: the candidates move once for each.
    m = rk.retrieval_features(c).select("user_id", "item_id", "label", *RANK_LIST_COLS).join(itf, "item_id", "left")
    m = rk.genre_overlap(m, rk.genre_preferences(history, oh), oh).join(uf, "user_id", "left")
    m = m.withColumn("item_popularity_pct", F.when(max_cnt > 0, F.coalesce("item_rating_count", F.lit(0)) / max_cnt)
                     .otherwise(F.lit(0.0)))
    m = m.select("user_id", "item_id", "label", *[F.coalesce(F.col(x).cast("double"), F.lit(0.0)).alias(x)
                                                  for x in RANK_FEATURES])  # 45 columns
    return m


@register("ranking_matrix")
def q_ranking_matrix(spark, sf):
    return round_doubles(_ranking_matrix(spark, sf))


@register("ranking_stats")
def q_ranking_stats(spark, sf):
    m = _ranking_matrix(spark, sf)
    stats = rk.dataset_stats(m, RANK_FEATURES)
    valid = rk.dataset_validity(m, ["user_id", "item_id", "label"] + RANK_FEATURES)
    return round_doubles(stats.select("*", valid.select("bad_labels").scalar().alias("bad_labels"),
                                      valid.select("valid").scalar().alias("valid")))


def _metric_long(gm, ks=(5, 10)):
    names = [f"{m}_{k}" for k in ks for m in ("ndcg", "hr", "mrr")]
    return gm.selectExpr(f"stack({len(names)}, " + ", ".join(f"'{n}', {n}" for n in names) + ") as (metric, value)")


@register("group_ndcg")
def q_group_ndcg(spark, sf):
    c, _, _ = _candidate_set(spark, sf)
    return round_doubles(rk.group_metrics(rk.baseline_score(rk.retrieval_features(c)), "baseline_score"))


@register("metric_comparison")
def q_metric_comparison(spark, sf):
    m = cut_lineage(_ranking_matrix(spark, sf).select("user_id", "item_id", "label", "rank_norm", "item_popularity_pct"))
    a = _metric_long(rk.group_metrics(m, "rank_norm"))
    b = _metric_long(rk.group_metrics(m, "item_popularity_pct"))
    return round_doubles(rk.compare_metrics(a, b))


@register("list_overlap")
def q_list_overlap(spark, sf):
    # A user's rows lie together, so both rankings ship ten rows a user.
    m = cut_lineage(_ranking_matrix(spark, sf).select("user_id", "item_id", "score", "item_popularity_pct")
                    .repartition("user_id"))
    a = rk.top_k_recommend(m, None, 10, score="score")
    b = rk.top_k_recommend(m, None, 10, score="item_popularity_pct")
    return round_doubles(rk.overlap_at_k(a, b, 10))


@register("top_k_ranked")
def q_top_k_ranked(spark, sf):
    m = _ranking_matrix(spark, sf).withColumn("final_score", sigmoid(F.col("score") + F.col("genre_overlap")))
    top = rk.top_k_recommend(m, _event_inter(spark, sf), 10, score="final_score")
    titles = A.items(spark, sf).select("item_id", "title")
    return round_doubles(top.join(titles, "item_id", "left").select(
        "user_id", "rank", "item_id", "final_score", F.coalesce("title", F.lit("Unknown")).alias("title")))


# ---- step 7: experiments and bandits --------------------------------------------------------------------
from kestrel.operators import experiment as ab, bandit as bd  # noqa: E402


def _requests_for(spark, sf, exp):
    return A.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.lit(exp).alias("experiment_id"))


@register("ab_assign")
def q_ab_assign(spark, sf):
    req = _requests_for(spark, sf, "retrieval_v1").unionByName(_requests_for(spark, sf, "ranking_blend_v1"))
    return ab.assign_variant(req, A.experiments(spark))


@register("ab_distribution")
def q_ab_distribution(spark, sf):
    return ab.variant_distribution(q_ab_assign(spark, sf))


@register("ab_config_check")
def q_ab_config_check(spark, sf):
    """A3 next to the traffic each configured experiment actually received (users seen in exposures)."""
    seen = A.exposures(spark, sf).groupBy("experiment_id").agg(F.count_distinct("user_id").alias("exposed_users"))
    return (ab.check_config(A.experiments(spark)).join(seen, "experiment_id", "left")
            .withColumn("exposed_users", F.coalesce("exposed_users", F.lit(0)).cast("bigint")))


def _ab_stats(spark, sf):
    return ab.variant_stats(A.exposures(spark, sf), A.conversions(spark, sf))


@register("ab_variant_stats")
def q_ab_variant_stats(spark, sf):
    return round_doubles(_ab_stats(spark, sf))


@register("ab_ztest")
def q_ab_ztest(spark, sf):
    return round_doubles(ab.z_test(_ab_stats(spark, sf), A.experiments(spark)))


@register("ab_report")
def q_ab_report(spark, sf):
    stats = _ab_stats(spark, sf)
    cfg = A.experiments(spark)
    return round_doubles(ab.report(cfg, stats, ab.z_test(stats, cfg)))


@register("ab_totals")
def q_ab_totals(spark, sf):
    e = ab.totals(A.exposures(spark, sf), "retrieval_v1").select(F.lit("exposures").alias("kind"), "n")
    c = ab.totals(A.conversions(spark, sf)).select(F.lit("conversions").alias("kind"), "n")
    return e.unionByName(c)


@register("ab_session_conversion")
def q_ab_session_conversion(spark, sf):
    ev = (A.table(spark, sf, "events").where(F.col("event_type").isin("view", "click"))
          .select("event_id", "user_id", "ts", (F.col("event_type") == "view").alias("is_exposure"),
                  (F.col("event_type") == "click").alias("is_conversion")))
    sess = feat.assign_sessions(ev)
    assigned = ab.assign_variant(sess.select("user_id", "session_start").distinct()
                                 .withColumn("experiment_id", F.lit("retrieval_v1")), A.experiments(spark))
    return round_doubles(ab.session_conversion(sess, assigned.select("user_id", "session_start", "variant")))


def _feedback(spark, sf):
    return A.feedback(spark, sf)


def _fb_halves(spark, sf):
    fb = _feedback(spark, sf)
    us = ts_to_micros(F.col("ts"))
    cut = fb.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).select(F.expr("(lo + hi) div 2")).scalar()
    return fb.where(us < cut), fb.where(us >= cut)


@register("bandit_posterior")
def q_bandit_posterior(spark, sf):
    return round_doubles(bd.arm_stats(bd.posterior(_feedback(spark, sf))))


@register("bandit_merge")
def q_bandit_merge(spark, sf):
    first, second = _fb_halves(spark, sf)
    return round_doubles(bd.merge(bd.posterior(first), second))


@register("bandit_stats")
def q_bandit_stats(spark, sf):
    n_items = A.table(spark, sf, "part").select(F.count(F.lit(1))).scalar()
    return round_doubles(bd.summary(bd.posterior(_feedback(spark, sf)), n_items))


@register("bandit_top")
def q_bandit_top(spark, sf):
    return round_doubles(bd.top_arms(bd.posterior(_feedback(spark, sf)), 20))


@register("bandit_parse")
def q_bandit_parse(spark, sf):
    arms = bd.posterior(_feedback(spark, sf))
    stored = arms.select("item_id", F.lit(None).cast("double").alias("alpha_field"),
                         F.lit(None).cast("double").alias("beta_field"),
                         F.concat_ws(":", F.col("alpha").cast("string"), F.col("beta").cast("string")).alias("legacy"))
    return bd.parse_arms(stored)


@register("bandit_learning")
def q_bandit_learning(spark, sf):
    first, _ = _fb_halves(spark, sf)
    truth = _feedback(spark, sf).groupBy("item_id").agg(F.avg("reward").alias("true_ctr"))
    return round_doubles(bd.learning_check(bd.posterior(first), truth))


@register("bandit_rerank")
def q_bandit_rerank(spark, sf):
    c, _, _ = _candidate_set(spark, sf)
    arms = bd.posterior(_feedback(spark, sf))
    r = bd.rerank(bd.fallback_scores(c), arms, weight=0.3, seed=42)
    return r.select("user_id", "cand_rank", "item_id", "score", "fallback_score", "draw", "blended", "new_rank")


@register("bandit_rerank_base")
def q_bandit_rerank_base(spark, sf):
    """B5 with all weight on the base score: the draw has no part in the order."""
    c, _, _ = _candidate_set(spark, sf)
    r = bd.rerank(c, bd.posterior(_feedback(spark, sf)), weight=1.0, seed=42)
    return round_doubles(r.select("user_id", "cand_rank", "item_id", "blended", "new_rank"))


@register("bandit_fallback")
def q_bandit_fallback(spark, sf):
    """B6 with the bandit off: every second candidate has lost its base score."""
    c, _, _ = _candidate_set(spark, sf)
    part = c.withColumn("score", F.when(F.col("cand_rank") % 2 == 1, F.col("score")))
    return round_doubles(bd.fallback_scores(part).select("user_id", "cand_rank", "item_id", "score", "fallback_score"))


@register("bandit_draws")
def q_bandit_draws(spark, sf):
    """Invariants of the draws over all (user, item) candidates: inside (0, 1), the same when
    drawn again, and the mean of the standardised draws near 0."""
    c, _, _ = _candidate_set(spark, sf)
    arms = bd.posterior(_feedback(spark, sf))
    one = bd.thompson_sample(c.select("user_id", "item_id"), arms, seed=42).withColumnRenamed("draw", "d1")
    two = bd.thompson_sample(c.select("user_id", "item_id").repartition(7, "item_id"), arms, seed=42).select(
        "user_id", "item_id", F.col("draw").alias("d2"))
    a, b = F.coalesce("alpha", F.lit(1.0)), F.coalesce("beta", F.lit(1.0))
    z = (F.col("d1") - a / (a + b)) / F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))
    return one.join(two, ["user_id", "item_id"]).agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("d1") > 0) & (F.col("d1") < 1)).alias("n_inside"),
        F.count_if(F.col("d1") == F.col("d2")).alias("n_repeated"),
        (F.abs(F.avg(z)) < 5.0 / F.sqrt(F.count(F.lit(1)))).alias("centred"))


# ---- step 8: monitoring and governance --------------------------------------------------------------
from kestrel.operators import monitoring as mon, governance as gov  # noqa: E402


def _requests(spark, sf):
    return A.requests(spark, sf)


@register("latency_sla")
def q_latency_sla(spark, sf):
    return round_doubles(mon.latency_sla(_requests(spark, sf)))


@register("stage_breakdown")
def q_stage_breakdown(spark, sf):
    return round_doubles(mon.stage_breakdown(_requests(spark, sf)))


@register("request_counters")
def q_request_counters(spark, sf):
    req = ab.assign_variant(_requests(spark, sf).withColumn("experiment_id", F.lit("retrieval_v1")), A.experiments(spark))
    return mon.counters(req)


@register("cache_hit_cumulative")
def q_cache_hit_cumulative(spark, sf):
    return round_doubles(mon.cache_ratio(_requests(spark, sf)))


@register("latency_histogram_quantile")
def q_latency_histogram_quantile(spark, sf):
    return round_doubles(mon.histogram_quantiles(_requests(spark, sf)))


@register("request_rate")
def q_request_rate(spark, sf):
    return round_doubles(mon.request_rate(_requests(spark, sf)))


@register("alert_windows")
def q_alert_windows(spark, sf):
    return round_doubles(mon.alert_windows(_requests(spark, sf)))


@register("alert_islands")
def q_alert_islands(spark, sf):
    w = mon.alert_windows(_requests(spark, sf))
    return (mon.sustained(w, "high_error", 2).unionByName(mon.sustained(w, "low_cache", 2))
            .unionByName(mon.sustained(w, "no_traffic", 1)))


@register("feedback_polarity")
def q_feedback_polarity(spark, sf):
    fb = ab.assign_variant(A.feedback(spark, sf).withColumn("experiment_id", F.lit("retrieval_v1")), A.experiments(spark))
    return mon.feedback_polarity(fb)


def _served_lists(spark, sf):
    c, _, _ = _candidate_set(spark, sf)
    top = c.where(F.col("cand_rank") <= 10).withColumn("experiment_id", F.lit("retrieval_v1"))
    return ab.assign_variant(top, A.experiments(spark))


@register("list_diversity")
def q_list_diversity(spark, sf):
    _, ig, _ = _genre_tables(spark, sf)
    return round_doubles(mon.list_diversity(_served_lists(spark, sf), ig))


@register("selection_concentration")
def q_selection_concentration(spark, sf):
    from kestrel.plans.ordering import competition_rank
    counts = A.feedback(spark, sf).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    ranks = competition_rank(counts, "n", "popularity_rank")
    return mon.selection_concentration(_served_lists(spark, sf), ranks)


@register("data_gate")
def q_data_gate(spark, sf):
    r = A.ratings(spark, sf)
    now = r.select(F.max("ts")).scalar()
    return gov.data_gate(r, now)


def _runs(spark, sf):
    c, _, _ = _candidate_set(spark, sf)
    fb = A.feedback(spark, sf)
    arms = bd.arm_stats(bd.posterior(fb)).select("item_id", "expected_ctr")
    pop = fb.groupBy("item_id").agg(F.count(F.lit(1)).cast("double").alias("popularity"))
    m = cut_lineage(c.join(arms, "item_id", "left").join(pop, "item_id", "left")
                    .fillna(0.0, ["expected_ctr", "popularity"]))
    start = fb.select(F.max("ts")).scalar()
    runs = None
    for run_id, name, col in ((1, "retrieval", "score"), (2, "bandit", "expected_ctr"), (3, "popularity", "popularity")):
        g = rk.group_metrics(m, col).select(F.lit(run_id).cast("bigint").alias("run_id"), F.lit("ranker").alias("model"),
                                            F.lit(name).alias("scorer"), F.col("ndcg_10"), F.col("hr_10"), F.col("mrr_10"),
                                            start.alias("start_time"))
        runs = g if runs is None else runs.unionByName(g)
    return runs


@register("quality_gate")
def q_quality_gate(spark, sf):
    runs = _runs(spark, sf)
    prod = runs.where(F.col("scorer") == "popularity")
    return round_doubles(gov.promotion(runs.where(F.col("scorer") != "popularity"), prod))


@register("best_run")
def q_best_run(spark, sf):
    runs = _runs(spark, sf)
    return round_doubles(gov.best_run(runs, "ndcg_10").join(gov.last_run(runs).select(
        "model", F.col("run_id").alias("last_run_id")), "model"))


@register("recent_runs")
def q_recent_runs(spark, sf):
    return round_doubles(gov.recent_runs(_runs(spark, sf), 10))


@register("version_transition")
def q_version_transition(spark, sf):
    v = _runs(spark, sf).select("model", F.col("run_id").alias("version"),
                                F.when(F.col("scorer") == "popularity", "Production").otherwise("None").alias("stage"))
    return gov.promote_latest(v)


@register("health_rollup")
def q_health_rollup(spark, sf):
    now = _now(spark, sf)
    fresh = quality.freshness(A.snapshots(spark, sf), "snapshots", now).select(
        F.lit("feature_store").alias("component"), F.when(F.col("passed"), "ok").otherwise("down").alias("status"))
    sla = mon.latency_sla(_requests(spark, sf)).where(F.col("path") == "Aggregated").select(
        F.lit("serving").alias("component"), F.when(F.col("p95_ok") & F.col("errors_ok"), "ok").otherwise("down").alias("status"))
    comps = fresh.unionByName(sla)
    return gov.roll_up(comps)


@register("metric_names")
def q_metric_names(spark, sf):
    g = rk.group_metrics(rk.retrieval_features(_candidate_set(spark, sf)[0]), "rank_norm")
    names = {"ndcg_5": "ndcg@5", "hr_5": "hr@5", "mrr_5": "mrr@5", "ndcg_10": "ndcg@10", "hr_10": "hit rate@10", "mrr_10": "mrr(10)"}
    long = g.selectExpr("stack(6, " + ", ".join(f"'{v}', {k}" for k, v in names.items()) + ") as (metric, value)")
    return round_doubles(gov.metric_names(long))


# ---- step 9: search -----------------------------------------------------------------------------------
from kestrel.operators import search as srch  # noqa: E402
from kestrel.functions.scalar import cosine_to_unit  # noqa: E402


def _title_queries(spark, sf):
    """Search strings derived from the catalogue names: full name, name minus its last two
    characters, the second word, and a one-letter substitution (e -> a)."""
    names = A.table(spark, sf, "part").select("p_name").distinct()
    parts = [("full", F.col("p_name")),
             ("prefix", F.expr("substring(p_name, 1, length(p_name) - 2)")),
             ("token", F.element_at(F.split("p_name", " "), 2)),
             ("typo", F.regexp_replace("p_name", "e", "a"))]
    out = None
    for kind, expr in parts:
        d = names.select(F.concat(F.lit(kind + ":"), F.col("p_name")).alias("query_id"), expr.alias("query_text"))
        out = d if out is None else out.unionByName(d)
    return out.where(F.col("query_text").isNotNull())


@register("title_normalize")
def q_title_normalize(spark, sf):
    return srch.normalized_catalogue(A.items(spark, sf))


@register("title_suggest")
def q_title_suggest(spark, sf):
    return srch.suggest(_title_queries(spark, sf), A.items(spark, sf), limit=8)


@register("title_fuzzy")
def q_title_fuzzy(spark, sf):
    return round_doubles(srch.suggest_with_fuzzy(_title_queries(spark, sf), A.items(spark, sf), limit=8))


@register("movie_seed_recommend")
def q_movie_seed_recommend(spark, sf):
    top1 = srch.suggest_with_fuzzy(_title_queries(spark, sf), A.items(spark, sf), limit=1).select(
        "query_id", F.col("item_id").alias("seed_id"))
    vec = _vectors(spark, sf)
    seeds = vx.resolve_seed(top1, vec).where(F.col("resolved_id").isNotNull())
    q = vec.join(seeds.select(F.col("resolved_id").alias("item_id")).distinct(), "item_id", "left_semi")
    sims = vx.topk_inner_product(q.withColumnRenamed("item_id", "seed_id"), vec, k=10, exclude_self=True, qid="seed_id")
    out = seeds.join(sims, seeds["resolved_id"] == sims["seed_id"]).select(
        "query_id", seeds["seed_id"].alias("matched_item"), "resolved_id", "rank", sims["item_id"],
        cosine_to_unit(F.col("score")).alias("similarity"))
    titles = A.items(spark, sf).select("item_id", "title")
    return out.join(titles, "item_id", "left")


# ---- step 6: negatives and sampled evaluation -----------------------------------------------------------
from kestrel.operators import negatives as ng  # noqa: E402


def _catalogue(spark, sf):
    return A.items(spark, sf).select("item_id")


@register("negatives_uniform")
def q_negatives_uniform(spark, sf):
    core = implicit_core(spark, sf)
    return ng.uniform(core.select("user_id"), core, _catalogue(spark, sf), n=10, seed=42)


@register("negatives_batch")
def q_negatives_batch(spark, sf):
    core = implicit_core(spark, sf)
    return ng.uniform(core.select("user_id"), core, _catalogue(spark, sf), n=1, seed=7)


@register("negatives_popularity")
def q_negatives_popularity(spark, sf):
    core = implicit_core(spark, sf)
    return ng.popularity(core.select("user_id"), core, ng.popularity_cdf(core), n=10, seed=42)


@register("negatives_per_position")
def q_negatives_per_position(spark, sf):
    core = implicit_core(spark, sf)
    keys = prep.sequence_positions(core).select("user_id", "pos")
    return ng.uniform(keys, core, _catalogue(spark, sf), n=128, seed=42, key_cols=("user_id", "pos"))


@register("pit_samples")
def q_pit_samples(spark, sf):
    ev = _event_inter(spark, sf)
    return ng.pit_samples(ev, ev, _catalogue(spark, sf), n_neg=4, seed=42)


@register("sampled_eval")
def q_sampled_eval(spark, sf):
    history, target = prep.holdout_last(implicit_core(spark, sf))
    cands = ng.sampled_candidates(target.select("user_id", "item_id"), _catalogue(spark, sf), n_neg=100, seed=42)
    pop = history.groupBy("item_id").agg(F.count(F.lit(1)).cast("double").alias("score"))
    return evaluation.metric_bundle(ng.sampled_rank(cands, pop), ks=(1, 5, 10))


# ---- step 6b: learning re-aims and full-ranking evaluation ---------------------------------------------
from kestrel.operators import cf, ranker  # noqa: E402


@register("full_ranking_eval")
def q_full_ranking_eval(spark, sf):
    history, target = prep.holdout_last(_event_items(spark, sf))
    vec = _vectors(spark, sf)
    q = (vx.pool_history(history, vec).join(target.select("user_id", F.col("item_id").alias("target_id")), "user_id")
         .withColumnRenamed("user_id", "qid"))
    pos = vx.target_position_masked(q, vec, history.withColumnRenamed("user_id", "qid"))
    return evaluation.metric_bundle(pos.withColumnRenamed("position", "rank"), ks=(5, 10, 20))


@register("full_ranking_pessimistic")
def q_full_ranking_pessimistic(spark, sf):
    """M13 with items of the target's own score before it."""
    history, target = prep.holdout_last(_event_items(spark, sf))
    vec = _vectors(spark, sf)
    q = (vx.pool_history(history, vec).join(target.select("user_id", F.col("item_id").alias("target_id")), "user_id")
         .withColumnRenamed("user_id", "qid"))
    pos = vx.target_position_masked(q, vec, history.withColumnRenamed("user_id", "qid"), ties="pessimistic")
    return evaluation.metric_bundle(pos.withColumnRenamed("position", "rank"), ks=(5, 10, 20))


@register("als_recommend")
def q_als_recommend(spark, sf):
    core = implicit_core(spark, sf)
    fitted = cf.fit_als(core, rank=64, max_iter=10)
    return cf.recommend_all(fitted, core, A.items(spark, sf), k=10)


@register("ivf_all_cells")
def q_ivf_all_cells(spark, sf):
    """V3 with every cell probed: the inverted lists together are the exact search."""
    v = _vectors(spark, sf)
    return round_doubles(cf.ivf_topk(v.withColumnRenamed("item_id", "qid"), v, k=10, nlist=20, nprobe=20))


@register("ivf_recall")
def q_ivf_recall(spark, sf):
    v = _vectors(spark, sf)
    q = v.withColumnRenamed("item_id", "qid")
    approx = cf.ivf_topk(q, v, k=10, nprobe=10)
    exact = vx.topk_inner_product(q, v, k=10)
    return cf.recall_vs_exact(approx, exact)


GBT = {"maxDepth": 5, "maxIter": 20}


@register("gbt_rank")
def q_gbt_rank(spark, sf):
    """Q13: fitted on the training users; metrics of the held-out users, and those of the baseline (Q17)."""
    train, test = ranker.split_users(cut_lineage(_ranking_matrix(spark, sf)))
    va, model = ranker.fit_ranker(train, RANK_FEATURES, "gbt", GBT)
    top = ranker.importance(model, RANK_FEATURES, 1).select("feature").scalar()
    own = rk.group_metrics(ranker.score(va, model, test), "rank_score", ks=(5, 10)).withColumn("top_feature", top)
    base = rk.group_metrics(test, "rank_norm", ks=(5, 10)).withColumn("top_feature", F.lit(None).cast("string"))
    return own.withColumn("ranker", F.lit("gbt")).unionByName(base.withColumn("ranker", F.lit("baseline")))


@register("lambda_rank")
def q_lambda_rank(spark, sf):
    """Q13, group-wise: NDCG of the held-out users beside that of the list order (Q17) and of popularity.

    List positions and scores are no features here: the positive put into a list stands at its end, so
    they give it away (and leave the list order no chance); user, item, pair and genre columns do not."""
    train, test = ranker.split_users(cut_lineage(_ranking_matrix(spark, sf)))
    model = ranker.fit_lambda(train, [c for c in RANK_FEATURES if c not in RANK_LIST_COLS])

    def ndcg(m, score, name):
        return rk.group_metrics(m, score, ks=(10,)).select(F.col("ndcg_10").alias(name))
    own = rk.group_metrics(model.score(test), "rank_score", ks=(5, 10)).withColumn("n_trees", F.lit(len(model.trees)))
    return own.join(ndcg(test, "rank_norm", "list_ndcg_10")).join(ndcg(test, "item_popularity", "popularity_ndcg_10"))


@register("feature_importance")
def q_feature_importance(spark, sf):
    train, _ = ranker.split_users(cut_lineage(_ranking_matrix(spark, sf)))
    _, model = ranker.fit_ranker(train, RANK_FEATURES, "gbt", GBT)
    return ranker.importance(model, RANK_FEATURES, 15)


@register("ranker_configs")
def q_ranker_configs(spark, sf):
    return ranker.compare_configs(*ranker.split_users(cut_lineage(_ranking_matrix(spark, sf))), RANK_FEATURES)


@register("two_stage_recommend")
def q_two_stage_recommend(spark, sf):
    """Q16: history -> pooled vector -> 100 candidates -> features -> model score -> top 10 -> titles.

    The model is fitted on the training users; the held-out users are served from what
    retrieval finds, without their held-out item put in."""
    train, served = ranker.split_users(cut_lineage(_ranking_matrix(spark, sf, inject=~ranker.held_out())))
    va, model = ranker.fit_ranker(train, RANK_FEATURES, "gbt", GBT)
    history, _ = prep.holdout_last(_event_inter(spark, sf))
    top = rk.top_k_recommend(ranker.score(va, model, served), history, 10, score="rank_score")
    return top.join(A.items(spark, sf).select("item_id", "title"), "item_id", "left").select(
        "user_id", "rank", "item_id", "rank_score", "title")


# ---- step 10: streaming --------------------------------------------------------------------------------
from kestrel.sources.tables import table  # noqa: E402
from kestrel.streaming import io as sio, jobs as sj  # noqa: E402


def _ntz(c):
    return F.col(c).cast("timestamp_ntz")


@register("stream_ingest")
def q_stream_ingest(spark, sf):
    ev = sio.table_stream(spark, sf, "events")
    s = sj.enrich(sj.ingest(sj.feedback_rows(ev)), A.experiments(spark))
    out = sio.run_stream(s.select("event_id", "user_id", "item_id", "reward", "clicked", "valid", "variant", "experiment_id"),
                         "ingest", "append")
    return out


@register("stream_bandit")
def q_stream_bandit(spark, sf):
    s = sj.posterior_updates(sj.feedback_rows(sio.table_stream(spark, sf, "events")))
    out = sio.run_stream(s, "bandit", "update", keys=["item_id"])
    return round_doubles(out.select("item_id", (F.lit(1.0) + F.col("successes")).alias("alpha"),
                                    (F.lit(1.0) + F.col("failures")).alias("beta")))


@register("stream_ctr")
def q_stream_ctr(spark, sf):
    s = sj.ctr_windows(sio.table_stream(spark, sf, "events"), A.experiments(spark)).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), "variant", "exposures", "conversions")
    out = sio.run_stream(s, "ctr", "update", keys=["window_start", "variant"])
    return round_doubles(out.withColumn("ctr", F.when(F.col("exposures") > 0, F.col("conversions") / F.col("exposures"))
                                        .otherwise(F.lit(0.0))))


@register("stream_latency")
def q_stream_latency(spark, sf):
    n_b = len(mon.LATENCY_BUCKETS)
    s = sj.latency_windows(sio.table_stream(spark, sf, "events")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n", "errors", *[f"le{i}" for i in range(n_b)])
    out = sio.run_stream(s, "latency", "update", keys=["window_start"])
    cums = F.array(*[F.col(f"le{i}") for i in range(n_b)])
    return round_doubles(out.select("window_start", "n", "errors", mon._hist_quantile(0.95, cums, F.col("n")).alias("q95")))


@register("stream_refresh_users")
def q_stream_refresh_users(spark, sf):
    s = sj.refresh_users(sj.feedback_rows(sio.table_stream(spark, sf, "events"))).select(
        "user_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "invalidated_at")
    return sio.run_stream(s, "refresh", "update", keys=["user_id", "window_start"])


@register("stream_cache_ttl")
def q_stream_cache_ttl(spark, sf):
    """X6 with state: entries that live 300 s from their last write, over late and out-of-order micro-batches."""
    return sio.run_replay(spark, table(spark, sf, "events"), "cache", sj.cache_entries, timers=True)


@register("stream_alerts")
def q_stream_alerts(spark, sf):
    """O16 with state: the resolved alerts, equal to the batch islands."""
    out = sio.run_replay(spark, table(spark, sf, "events"), "alerts", sj.alert_states, timers=True)
    return out.where("state = 'resolved'").drop("state")


@register("stream_sessions")
def q_stream_sessions(spark, sf):
    def job(s):
        return sj.sessions(s).select("user_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                                     F.col("s.end").cast("timestamp_ntz").alias("session_end"), "n_events")
    # Append mode: a session is emitted once and leaves the state when the watermark passes its end.
    return sio.run_replay(spark, table(spark, sf, "events"), "sessions", job).where(
        F.coalesce("user_id", F.lit(0)) != sio.CLOSING_USER)


@register("stream_dedup")
def q_stream_dedup(spark, sf):
    a = sio.table_stream(spark, sf, "events")
    b = sio.table_stream(spark, sf, "events")  # the same log delivered twice (a replay)
    s = sj.dedup(a.unionByName(b)).select("event_id", "user_id", "ts", "event_type")
    return sio.run_stream(s, "dedup", "append")


@register("stream_attribution_pairs")
def q_stream_attribution_pairs(spark, sf):
    views = sio.table_stream(spark, sf, "events").where(F.col("event_type") == "view")
    clicks = sio.table_stream(spark, sf, "events").where(F.col("event_type") == "click")
    return sio.run_stream(sj.attribute(views, clicks, "1 hour"), "attribution", "append")


@register("stream_attribution")
def q_stream_attribution(spark, sf):
    """Every click with the variant of the user's last view in the hour before, else 'unknown'."""
    def job(s):
        # Closing rows pass both filters, or the watermark would stop at the last row.
        views = ab.assign_variant(s.where(F.col("event_type").isin("view", sio.CLOSING)).withColumn(
            "experiment_id", F.lit(A.DEFAULT_EXPERIMENT)), A.experiments(spark))
        clicks = s.where(F.col("event_type").isin("click", sio.CLOSING)).withColumn("variant", F.lit(None).cast("string"))
        return sj.attribute_last(views, clicks, "1 hour")
    out = sio.run_replay(spark, table(spark, sf, "events"), "attribution", job)
    return out.where("conversion_id IS NOT NULL")


# ---- sources and sinks (round trips through the shared checkpoint folder) -----------------------------------
from kestrel.sources import files as fio  # noqa: E402


def _scratch(spark, name):
    return sio.scratch(spark, "files", name)


@register("ratings_csv_roundtrip")
def q_ratings_csv_roundtrip(spark, sf):
    path = _scratch(spark, "ratings_csv")
    fio.write_ratings_csv(A.ratings(spark, sf), path)
    return round_doubles(fio.read_ratings(spark, path))


@register("items_csv_roundtrip")
def q_items_csv_roundtrip(spark, sf):
    path = _scratch(spark, "items_csv")
    A.items(spark, sf).select(F.col("item_id").alias("movieId"), "title", "genres").write.option("header", True).csv(path)
    return fio.read_items(spark, path)


@register("event_log_roundtrip")
def q_event_log_roundtrip(spark, sf):
    path = _scratch(spark, "exposures_jsonl")
    ex = A.exposures(spark, sf).select("user_id", "variant", "experiment_id", F.col("n_recs").cast("int").alias("n_recs"),
                                       (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts"), "event_id")
    fio.write_event_log(ex, path)
    good, bad = fio.read_event_log(spark, path, fio.EXPOSURE_LOG)
    n_bad = bad.select(F.count(F.lit(1))).scalar()
    return round_doubles(good.withColumn("n_bad_lines", n_bad))


@register("request_log_roundtrip")
def q_request_log_roundtrip(spark, sf):
    path = _scratch(spark, "latency_csv")
    fio.write_request_log(_requests(spark, sf), path)
    return round_doubles(mon.latency_sla(fio.read_request_log(spark, path)))


@register("feature_cache_roundtrip")
def q_feature_cache_roundtrip(spark, sf):
    """The wide genre table cached and loaded; per genre column its place and its number of items."""
    path = _scratch(spark, "feature_cache")
    items = A.items(spark, sf)
    wide = feat.genre_wide(feat.item_genres_long(items), GENRES)
    fio.save_feature_cache(spark, {"items": items.select("item_id").join(wide, "item_id", "left").fillna(0)}, path)
    tables, genres = fio.load_feature_cache(spark, path, ["items"])
    sums = tables["items"].agg(F.count(F.lit(1)).alias("n_items"), *[F.sum(f"`{g}`").alias(g) for g in genres])
    return sums.select("n_items", F.posexplode(F.array(*[
        F.struct(F.lit(g).alias("genre_name"), F.col(f"`{g}`").alias("n_with")) for g in genres])).alias(
        "place", "s")).select("place", "s.genre_name", "s.n_with", "n_items")


@register("id_maps_roundtrip")
def q_id_maps_roundtrip(spark, sf):
    """Item ids of the k-core mapped, the map written and read, every rating encoded and decoded."""
    path = _scratch(spark, "item_map")
    core = implicit_core(spark, sf)
    fio.write_id_maps(prep.dense_encode(core, "item_id", "item_idx"), path)
    m = fio.read_id_maps(spark, path, "item_id", "item_idx")
    encoded = prep.encode(core, m, "item_id", "item_idx").select("user_id", "tie", "item_idx")
    return encoded.join(m, "item_idx").select("user_id", "tie", "item_idx", "item_id")


@register("aligned_ids")
def q_aligned_ids(spark, sf):
    """Item indexes from 0 (as an encoder without PAD gives them) beside sequences that start at 1."""
    core = implicit_core(spark, sf)
    m = prep.dense_encode(core, "item_id", "item_idx")
    sequences = prep.encode(core, m, "item_id", "item_idx").select("user_id", "tie", "item_idx")
    zero_based = prep.shift_ids(sequences, ["item_idx"], by=-1)
    return prep.align_id_base(zero_based, sequences, "item_idx", "item_idx")


@register("feature_store_write")
def q_feature_store_write(spark, sf):
    path = _scratch(spark, "user_features")
    uf = feat.user_features(A.ratings(spark, sf, min_rating=4.0), A.items(spark, sf), A.genre_vocab(spark, sf),
                            idmap=user_map(spark, sf))
    fio.write_features(round_doubles(uf), path, "user_idx")
    return spark.read.parquet(path)


@register("training_samples")
def q_training_samples(spark, sf):
    ps = prep.prefix_samples(implicit_core(spark, sf), max_len=50).select(
        "user_id", F.col("prefix").alias("sequence"), F.col("target_item").alias("next_item"))
    r = fio.resolve_samples(ps)
    return r.select("user_id", F.array_join(F.col("input_seq").cast("array<string>"), ",").alias("input_seq"), "target")


@register("report_roundtrip")
def q_report_roundtrip(spark, sf):
    path = _scratch(spark, "report_json")
    fio.save_report(popularity_eval(spark, sf), path, "json")
    schema = "k bigint, n_users bigint, hr double, ndcg double, mrr double, precision double, mean_rank double, median_rank double"
    return spark.read.schema(schema).json(path)


@register("loadtest_stats")
def q_loadtest_stats(spark, sf):
    path = _scratch(spark, "loadtest_csv")
    sla = mon.latency_sla(_requests(spark, sf))
    sla.select(F.col("path").alias("Name"), F.col("n").alias("Request Count"), F.col("errors").alias("Failure Count"),
               F.col("rps").alias("Requests/s"), F.col("p50_ms").alias("50%"), F.col("p95_ms").alias("95%"),
               F.col("p99_ms").alias("99%"), F.col("avg_ms").alias("Average (ms)")).write.option("header", True).csv(path)
    return round_doubles(fio.read_loadtest_stats(spark, path))


# ---- remaining inventory items ----------------------------------------------------------------------------------

@register("rank_distribution")
def q_rank_distribution(spark, sf):
    """M9: distribution of the held-out item's masked full-ranking position."""
    history, target = prep.holdout_last(_event_items(spark, sf))
    vec = _vectors(spark, sf)
    q = (vx.pool_history(history, vec).join(target.select("user_id", F.col("item_id").alias("target_id")), "user_id")
         .withColumnRenamed("user_id", "qid"))
    pos = vx.target_position_masked(q, vec, history.withColumnRenamed("user_id", "qid"))
    cuts = [1, 3, 5, 10, 20, 50, 100, 200]
    wide = pos.agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("min_rank"), F.max("position").alias("max_rank"),
                   F.avg("position").alias("mean_rank"),
                   F.percentile(F.col("position").cast("double"), 0.5).alias("median_rank"),
                   *[F.count_if(F.col("position") <= c).alias(f"c{c}") for c in cuts])
    long = wide.selectExpr("n", "min_rank", "max_rank", "mean_rank", "median_rank",
                           f"stack({len(cuts)}, " + ", ".join(f"{c}, c{c}" for c in cuts) + ") as (cutoff, n_within)")
    return round_doubles(long.select(F.col("cutoff").cast("bigint").alias("cutoff"), "n_within",
                                     (F.col("n_within") / F.col("n") * 100.0).alias("pct_within"),
                                     "min_rank", "max_rank", "mean_rank", "median_rank"))


@register("val_test_pivot")
def q_val_test_pivot(spark, sf):
    """The most-popular recommender on the validation (second newest) and test (newest) items."""
    core = implicit_core(spark, sf)
    train, val, test = prep.leave_last_out(core)
    hist_val = train
    hist_test = train.unionByName(val)
    bv = evaluation.metric_bundle(evaluation.popularity_target_rank(hist_val, val), ks=(10,))
    bt = evaluation.metric_bundle(evaluation.popularity_target_rank(hist_test, test), ks=(10,))
    def long(b, split):
        return b.selectExpr(f"'{split}' as split", "stack(3, 'hr_10', hr, 'ndcg_10', ndcg, 'mrr_10', mrr) as (metric, value)")
    both = long(bv, "val").unionByName(long(bt, "test"))
    return both.groupBy("metric").pivot("split", ["val", "test"]).agg(F.first("value"))


@register("decode_ids")
def q_decode_ids(spark, sf):
    """events' user ids read as dense user indexes of the k-core map; unmapped -> 'Unknown_<idx>'."""
    m = user_map(spark, sf)
    req = A.table(spark, sf, "events").select(F.col("user_id").alias("user_idx")).distinct()
    return prep.decode(req, m, "user_id", "user_idx").select("user_idx", F.col("user_id").alias("raw_id"))


@register("cap_users")
def q_cap_users(spark, sf):
    return prep.cap_users(implicit_core(spark, sf), 100, seed=42).select("user_id").distinct()


@register("label_coverage")
def q_label_coverage(spark, sf):
    """Users with a held-out label and a history sequence; labels without history."""
    history, target = prep.holdout_last(_event_items(spark, sf))
    lab = target.select("user_id").distinct()
    seq = history.select("user_id").distinct()
    both = lab.join(seq, "user_id", "inner")
    missing = lab.join(seq, "user_id", "left_anti")
    return (lab.agg(F.count(F.lit(1)).alias("n_label_users"))
            .withColumn("n_sequence_users", seq.select(F.count(F.lit(1))).scalar())
            .withColumn("n_both", both.select(F.count(F.lit(1))).scalar())
            .withColumn("n_missing", missing.select(F.count(F.lit(1))).scalar()))


# Training names, and two leaky ones that must come out as missing.
SERVING_NAMES = ["u_user_rating_count", "u_user_avg_rating", "u_user_days_since_last", "u_user_sequence_length",
                 "i_item_active_days", "i_item_rating_count", "user_last_timestamp", "item_first_timestamp"]


@register("serving_alignment")
def q_serving_alignment(spark, sf):
    """Store lookup -> serving names -> training names -> aligned, float-only matrix."""
    req = A.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    look = fs.entity_lookup(req, _user_store(spark, sf), "user_id", fs.USER_DEFAULTS)
    log_count = F.log1p(F.col("total_interactions").cast("double"))
    served = look.select(
        "user_id", "found", log_count.alias("user_interaction_count_log"), F.col("avg_rating").alias("user_avg_rating"),
        F.col("recency_days").alias("user_recency_days"), F.col("active_days").alias("item_active_days"),
        log_count.alias("item_rating_count_log"), F.lit(1.0).alias("user_last_timestamp"),
        F.lit(1.0).alias("item_first_timestamp"))
    renamed = prep.drop_leaky(prep.rename_serving_to_training(served))
    aligned = prep.align_features(renamed, SERVING_NAMES + ["found"], keep=("user_id",))
    return round_doubles(prep.to_float_matrix(aligned))


@register("padded_lists")
def q_padded_lists(spark, sf):
    c, _, _ = _candidate_set(spark, sf)
    return round_doubles(rk.pad_lists(c.drop("label"), 100))


@register("vector_self_check")
def q_vector_self_check(spark, sf):
    """V7: share of vectors whose own id is their top-1 inner-product neighbour."""
    v = _vectors(spark, sf)
    top1 = vx.topk_inner_product(v.withColumnRenamed("item_id", "qid"), v, k=1)
    return round_doubles(top1.agg(F.count(F.lit(1)).alias("n_vectors"),
                                  F.avg((F.col("qid") == F.col("item_id")).cast("double")).alias("self_top1_share")))


# ---- Q6 / Q7: feature-service and serving matrices ------------------------------------------------------
STORE_ITEM_COLS = ["global_popularity", "popularity_rank", "niche_score", "avg_ratings_per_day", "avg_item_rating",
                   "rating_count", "rating_std", "high_rating_ratio", "genre_count", "primary_genre_idx", "release_year",
                   "item_age_days"]


@register("store_matrix")
def q_store_matrix(spark, sf):
    """Q6: candidates x user store (15, defaults) x item store (12, defaults) + score, rank, primary-genre overlap."""
    c, history, _ = _candidate_set(spark, sf)
    _, _, primary = _genre_tables(spark, sf)
    us = fs.entity_lookup(c.select("user_id").distinct(), _user_store(spark, sf), "user_id", fs.USER_DEFAULTS)
    istore = feat.item_features(A.ratings(spark, sf), A.items(spark, sf), A.genre_vocab(spark, sf))
    its = fs.entity_lookup(c.select("item_id").distinct(), istore, "item_id", fs.ITEM_DEFAULTS)
    m = rk.primary_genre_overlap(c, history, primary)
    m = (m.join(us.select("user_id", *[F.col(k).alias("u_" + k) for k in fs.USER_DEFAULTS]), "user_id", "left")
         .join(its.select("item_id", *[F.col(k).alias("i_" + k) for k in fs.ITEM_DEFAULTS]), "item_id", "left"))
    return round_doubles(m.select("user_id", "cand_rank", "item_id", "label", "score",
                                  *["u_" + k for k in fs.USER_DEFAULTS], *["i_" + k for k in fs.ITEM_DEFAULTS],
                                  "primary_genre_overlap"))


SERVING_COLS = ["faiss_score", "faiss_rank_normalized", "item_log_popularity", "item_avg_rating", "item_rating_count_log",
                "item_recency_days", "item_year", "item_active_days", "user_interaction_count_log", "user_avg_rating",
                "user_recency_days", "user_seq_length", "genre_overlap", "is_same_top_genre", "mf_score"]


@register("serving_matrix")
def q_serving_matrix(spark, sf):
    """Q7: the 15 serving columns in configured order (N5 list features, Q3 overlap, defaults)."""
    c, history, _ = _candidate_set(spark, sf)
    _, ig, _ = _genre_tables(spark, sf)
    lens = history.groupBy("user_id").agg(F.count(F.lit(1)).alias("user_sequence_length"))
    uf = feat.rank_user_features(history, lens)
    itf = feat.rank_item_features(history, A.items(spark, sf))
    m = rk.online_overlap(rk.retrieval_features(c), history, ig, last=50)
    m = m.join(uf, "user_id", "left").join(itf, "item_id", "left")
    cols = {
        "faiss_score": F.col("score"), "faiss_rank_normalized": F.col("rank_norm_serve"),
        "item_log_popularity": F.coalesce("item_log_popularity", "item_rating_count", F.lit(0.0)),
        "item_avg_rating": F.coalesce("item_avg_rating", F.lit(3.0)),
        "item_rating_count_log": F.coalesce("item_rating_count", F.lit(0.0)),
        "item_recency_days": F.coalesce("item_days_since_last_rating", F.lit(730.0)),
        "item_year": F.coalesce("item_year", F.lit(2000.0)),
        "item_active_days": F.coalesce("item_active_days", F.lit(365.0)),
        "user_interaction_count_log": F.coalesce("user_rating_count", F.lit(0.0)),
        "user_avg_rating": F.coalesce("user_avg_rating", F.lit(3.5)),
        "user_recency_days": F.coalesce("user_days_since_last", F.lit(365.0)),
        "user_seq_length": F.coalesce("user_sequence_length", F.lit(10.0)),
        "genre_overlap": F.col("online_overlap"), "is_same_top_genre": F.col("is_same_top_genre"),
        "mf_score": F.lit(0.0)}
    out = m.select("user_id", "cand_rank", "item_id", *[v.cast("double").alias(k) for k, v in cols.items()])
    return round_doubles(prep.align_features(out, SERVING_COLS, keep=("user_id", "cand_rank", "item_id")))


@register("serving_popularity")
def q_serving_popularity(spark, sf):
    """popularity_pct of each served list, from its log popularity."""
    m = rk.popularity_pct(q_serving_matrix(spark, sf), "item_log_popularity")
    return round_doubles(m.select("user_id", "cand_rank", "item_id", "popularity_pct"))


@register("request_increase_24h")
def q_request_increase_24h(spark, sf):
    return mon.increase(_requests(spark, sf), "24 hours")


@register("explode_positives")
def q_explode_positives(spark, sf):
    return prep.explode_positives(prep.padded_sequences(implicit_core(spark, sf), length=50))


@register("clamped_sequences")
def q_clamped_sequences(spark, sf):
    """Padded sequences with ids forced into [0, n_items - 1] of the catalogue (n from the part table)."""
    from kestrel.functions.scalar import clamp_ids
    n_items = A.table(spark, sf, "part").count()
    s = prep.padded_sequences(implicit_core(spark, sf), length=50)
    return s.select("user_id", F.array_join(clamp_ids(F.col("seq"), n_items).cast("array<string>"), ",").alias("seq"))
