"""Ranking-set construction (N4, N5, Q1-Q12, Q17, T1, T5) and group metrics.

A candidate list is long-form: (user_id, cand_rank, item_id, score).  Lists
are bounded (k candidates per user), so per-user windows over them are
bounded too; everything that touches history is an aggregate or equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from kestrel.plans.topk import top_k


# ---- N4 / N5 ---------------------------------------------------------------------------------

def retrieval_features(c: DataFrame, user: str = "user_id", rank: str = "cand_rank", score: str = "score") -> DataFrame:
    """Training form (N4) and serving form (N5) list features, side by side."""
    wu = W.partitionBy(user)
    wo = W.partitionBy(user).orderBy(F.col(rank))
    n = F.count(F.lit(1)).over(wu)
    lo, hi = F.min(score).over(wu), F.max(score).over(wu)
    top = F.first(score).over(wo.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    prev = F.lag(score).over(wo)
    r = F.col(rank).cast("double")
    return c.select(
        "*",
        F.when(n > 1, F.lit(1.0) - (r - 1.0) / (n - 1)).otherwise(F.lit(1.0)).alias("rank_norm"),
        F.when(hi > lo, (F.col(score) - lo) / (hi - lo)).otherwise(F.lit(0.5)).alias("score_norm"),
        F.coalesce(prev - F.col(score), F.lit(0.0)).alias("score_gap"),
        (r / n).alias("rank_norm_serve"),
        (top - F.col(score)).alias("score_gap_top"),
        F.when(hi > lo, (F.col(score) - lo) / (hi - lo)).otherwise(F.lit(0.0)).alias("score_norm_serve"))


def popularity_pct(m: DataFrame, by: str, user: str = "user_id") -> DataFrame:
    """Min-max of ``by`` within each candidate list; a flat list gets 0."""
    w = W.partitionBy(user)
    lo, hi = F.min(by).over(w), F.max(by).over(w)
    return m.withColumn("popularity_pct", F.when(hi - lo > 1e-8, (F.col(by) - lo) / (hi - lo)).otherwise(F.lit(0.0)))


# ---- genres --------------------------------------------------------------------------------------

def genre_preferences(history: DataFrame, oh: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Q1: share of each genre in the user's history (sum of one-hots / total)."""
    counts = history.select(user, item).join(oh, item).groupBy(user, "genre").agg(F.count(F.lit(1)).alias("_c"))
    total = counts.groupBy(user).agg(F.sum("_c").alias("_t"))
    return counts.join(total, user).select(user, "genre", (F.col("_c") / F.col("_t")).alias("pref"))


def genre_overlap(c: DataFrame, prefs: DataFrame, oh: DataFrame, user: str = "user_id",
                  item: str = "item_id") -> DataFrame:
    """Q2: genre_overlap = sum of the user's preferences over the candidate's genres; genre_max_match = max."""
    return (c.join(_item_list(oh, item), item, "left").join(_user_map(prefs, user, "genre", "pref"), user, "left")
            .withColumn("genre_overlap", _share(F.col("_gs"), F.col("_m")))
            .withColumn("genre_max_match", F.coalesce(F.array_max(F.transform(
                F.col("_gs"), lambda g: F.coalesce(F.col("_m")[g], F.lit(0.0)))), F.lit(0.0)))
            .drop("_gs", "_m"))


def _item_list(genres: DataFrame, item: str) -> DataFrame:
    """(item, _gs): the genre rows of an item as one array."""
    return genres.where(F.col("genre").isNotNull()).groupBy(item).agg(F.collect_list("genre").alias("_gs"))


def _user_map(rows: DataFrame, user: str, key: str, value: str) -> DataFrame:
    """(user, _m): a user's values by key, at most one entry per genre of the vocabulary."""
    return (rows.where(F.col(key).isNotNull()).groupBy(user)
            .agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("_m")))


def _share(genres, values):
    """Sum of a user's values over an item's genres; 0 for none."""
    return F.coalesce(F.aggregate(genres, F.lit(0.0), lambda a, g: a + F.coalesce(values[g], F.lit(0.0))), F.lit(0.0))


def online_overlap(c: DataFrame, history: DataFrame, item_genres: DataFrame, last: int = 50,
                   user: str = "user_id", item: str = "item_id", time_cols=("ts", "tie")) -> DataFrame:
    """Q3 (serving form): profile = genre counts over the last ``last`` history items;
    overlap = sum of the profile shares of the candidate's genres / #genres;
    is_same_top_genre = candidate has the profile's top genre (count desc, name asc)."""
    recent = top_k(history, [user], [F.col(t).desc() for t in time_cols], last, "_r")
    prof = recent.select(user, item).join(item_genres, item).groupBy(user, "genre").agg(F.count(F.lit(1)).alias("_c"))
    tot = prof.groupBy(user).agg(F.sum("_c").alias("_t"))
    topg = (top_k(prof, [user], [F.col("_c").desc(), F.col("genre").asc()], 1, "_r2")
            .select(user, F.col("genre").alias("top_genre")))
    share = prof.join(tot, user).select(user, "genre", (F.col("_c") / F.col("_t")).alias("_s"))
    ig = item_genres.groupBy(item).agg(F.count(F.lit(1)).alias("_ng"))
    known = _user_map(share, user, "genre", "_s").join(topg, user, "left")
    return (c.join(ig, item, "left").join(_item_list(item_genres, item), item, "left").join(known, user, "left")
            .withColumn("online_overlap", F.when(F.col("_ng") > 0, _share(F.col("_gs"), F.col("_m")) / F.col("_ng"))
                        .otherwise(F.lit(0.0)))
            .withColumn("is_same_top_genre", F.coalesce(F.array_contains("_gs", F.col("top_genre")).cast("bigint"),
                                                        F.lit(0).cast("bigint")))
            .drop("_ng", "_gs", "_m", "top_genre"))


def primary_genre_overlap(c: DataFrame, history: DataFrame, primary: DataFrame, user: str = "user_id",
                          item: str = "item_id") -> DataFrame:
    """Q4: share of the user's history items whose primary genre equals the candidate's."""
    hp = history.select(user, item).join(primary, item)
    per = hp.groupBy(user, "primary_genre_idx").agg(F.count(F.lit(1)).alias("_c"))
    tot = history.groupBy(user).agg(F.count(F.lit(1)).alias("_t"))
    cp = c.join(primary.withColumnRenamed("primary_genre_idx", "_pg"), item, "left")
    known = tot.join(_user_map(per, user, "primary_genre_idx", "_c"), user, "left")
    out = cp.join(known, user, "left")
    return out.withColumn("primary_genre_overlap",
                          F.when(F.col("_t") > 0, F.coalesce(F.col("_m")[F.col("_pg")], F.lit(0)) / F.col("_t"))
                          .otherwise(F.lit(0.0))).drop("_m", "_t", "_pg")


# ---- Q8 / Q9 / Q10 ---------------------------------------------------------------------------------

def label(c: DataFrame, targets: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    t = targets.select(user, F.col(item).alias("_t"))
    return (c.join(t, user, "left").withColumn("label", F.coalesce((F.col(item) == F.col("_t")).cast("int"), F.lit(0)))
            .drop("_t"))


def inject_positive(c: DataFrame, targets: DataFrame, user: str = "user_id", item: str = "item_id",
                    rank: str = "cand_rank", score: str = "score") -> DataFrame:
    """Make sure each target user's list contains the target: when absent, it replaces the
    last candidate, however short the list is (score = list min - 1e-6); a user without a
    list gets [target] with score 0."""
    t = targets.select(user, F.col(item).alias("_t"))
    # One row per user beside the list, so the list meets its targets and is looked over in one place.
    wanted = t.groupBy(user).agg(F.collect_list(F.struct("_t")).alias("_ts"))
    wu = W.partitionBy(user)
    has = F.coalesce(F.exists("_ts", lambda x: x["_t"] == F.col(item)), F.lit(False))
    listed = c.join(wanted, user, "left").select(
        *c.columns, "_ts", F.max(has).over(wu).alias("_has"), F.min(score).over(wu).alias("_min"),
        F.max(rank).over(wu).alias("_last"), F.row_number().over(wu.orderBy(F.col(rank).desc())).alias("_back"))
    # The last place makes room, and is taken by the target; other places stay.
    short = F.col("_ts").isNotNull() & ~F.col("_has")
    stays = listed.where(~short | (F.col("_back") == 1) | ~F.col(rank).eqNullSafe(F.col("_last")))
    taken = short & (F.col("_back") == 1) & F.col("_last").isNotNull()
    own = F.array(F.struct(F.col(item).alias("_t")))
    stays = stays.withColumn("_i", F.explode(F.when(taken, F.col("_ts")).otherwise(own)))
    put = F.when(taken, F.col("_min") - F.lit(1e-6)).otherwise(F.col(score))
    stays = stays.select(*[F.col("_i._t").alias(x) if x == item else put.alias(x) if x == score else F.col(x)
                           for x in c.columns])
    alone = t.join(c.select(user).distinct(), user, "left_anti")
    return stays.unionByName(alone.select(user, F.lit(1).cast(c.schema[rank].dataType).alias(rank),
                                          F.col("_t").alias(item), F.lit(0.0).alias(score)))


def pad_lists(c: DataFrame, n: int = 100, user: str = "user_id", rank: str = "cand_rank",
              item: str = "item_id", score: str = "score") -> DataFrame:
    """Q10: extend every list to n rows with item 0 / score 0."""
    wu = W.partitionBy(user)
    at = c.select("*", F.max(rank).over(wu).alias("_m"), F.row_number().over(wu.orderBy(F.col(rank).desc())).alias("_back"))
    # The row of the last place is followed by the ranks that are missing, so a list is read once.
    # sequence(m + 1, n) would count down when the list is already full, so only short lists pad.
    more = F.when((F.col("_back") == 1) & (F.col("_m") < n), F.sequence((F.col("_m") + 1).cast("bigint"), F.lit(n).cast("bigint")))
    ranks = F.concat(F.array(F.col(rank).cast("bigint")), F.coalesce(more, F.array().cast("array<bigint>")))
    own = F.col("_p") == 0
    empty = {rank: F.col("_r").cast(c.schema[rank].dataType), item: F.lit(0).cast("bigint"), score: F.lit(0.0)}
    return at.select("*", F.posexplode(ranks).alias("_p", "_r")).select(
        *[F.col(x) if x == user else F.when(own, F.col(x)).otherwise(empty.get(x)).alias(x) for x in c.columns])


# ---- Q11 / Q12 -----------------------------------------------------------------------------------------

def dataset_stats(m: DataFrame, feature_cols: list, user: str = "user_id") -> DataFrame:
    """rows, users, features, positive rate, hit rate (share of users with a positive)."""
    per_user = m.groupBy(user).agg(F.max("label").alias("_hit"))
    hit_rate = per_user.select(F.avg(F.col("_hit").cast("double"))).scalar()
    return m.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(user).alias("n_users"),
                 F.avg(F.col("label").cast("double")).alias("positive_rate")).select(
        "n_rows", "n_users", F.lit(len(feature_cols)).cast("bigint").alias("n_features"), "positive_rate",
        hit_rate.alias("hit_rate"))


def dataset_validity(m: DataFrame, required: list) -> DataFrame:
    missing = [c for c in required if c not in m.columns]
    r = m.agg(F.count_if(~F.col("label").isin(0, 1) | F.col("label").isNull()).alias("bad_labels"))
    return r.select(F.lit(len(missing)).cast("bigint").alias("missing_columns"), "bad_labels",
                    ((F.col("bad_labels") == 0) & F.lit(len(missing) == 0)).alias("valid"))


# ---- M6 / M7 / Q17 ----------------------------------------------------------------------------------------

def group_metrics(m: DataFrame, score_col: str, ks=(5, 10), user: str = "user_id", item: str = "item_id",
                  rel: str = "label") -> DataFrame:
    """Per group: graded NDCG@k (gain 2^rel - 1, ideal 0 -> 0), HR@k and MRR@k, then averaged.

    Two bounded per-group orderings (by score desc / item, and by relevance
    desc); lists are bounded so the windows are too.
    """
    ws = W.partitionBy(user).orderBy(F.col(score_col).desc(), F.col(item).asc())
    wr = W.partitionBy(user).orderBy(F.col(rel).desc(), F.col(score_col).desc(), F.col(item).asc())
    x = m.select(user, item, F.col(score_col), F.col(rel).cast("double").alias("_rel"),
                 F.row_number().over(ws).alias("_rs"), F.row_number().over(wr).alias("_ri"))
    gain = F.pow(F.lit(2.0), F.col("_rel")) - 1.0
    aggs = []
    for k in ks:
        aggs += [F.sum(F.when(F.col("_rs") <= k, gain / F.log2(F.col("_rs") + 1.0)).otherwise(0.0)).alias(f"_dcg{k}"),
                 F.sum(F.when(F.col("_ri") <= k, gain / F.log2(F.col("_ri") + 1.0)).otherwise(0.0)).alias(f"_idcg{k}"),
                 F.max(F.when((F.col("_rs") <= k) & (F.col("_rel") > 0), 1.0).otherwise(0.0)).alias(f"_hr{k}"),
                 F.max(F.when((F.col("_rs") <= k) & (F.col("_rel") > 0), 1.0 / F.col("_rs")).otherwise(0.0)).alias(f"_mrr{k}")]
    per = x.groupBy(user).agg(*aggs)
    outs = [F.count(F.lit(1)).alias("n_groups")]
    for k in ks:
        outs += [F.avg(F.when(F.col(f"_idcg{k}") > 0, F.col(f"_dcg{k}") / F.col(f"_idcg{k}")).otherwise(0.0)).alias(f"ndcg_{k}"),
                 F.avg(f"_hr{k}").alias(f"hr_{k}"), F.avg(f"_mrr{k}").alias(f"mrr_{k}")]
    return per.agg(*outs)


def baseline_score(c: DataFrame) -> DataFrame:
    """Q17: rank_norm when present, else the raw score, else 1 - (rank - 1) / (n - 1)."""
    cols = c.columns
    parts = []
    if "rank_norm" in cols:
        parts.append(F.col("rank_norm"))
    if "score" in cols:
        parts.append(F.col("score"))
    n = F.count(F.lit(1)).over(W.partitionBy("user_id"))
    parts.append(F.when(n > 1, F.lit(1.0) - (F.col("cand_rank") - 1.0) / (n - 1)).otherwise(F.lit(1.0)))
    return c.withColumn("baseline_score", F.coalesce(*parts))


def compare_metrics(a: DataFrame, b: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    """Per metric, a vs b: delta, % change (0 when a is 0) and a marker (> 0.005 '++', > 0 '+', else '-')."""
    j = a.select(metric, F.col(value).alias("a")).join(b.select(metric, F.col(value).alias("b")), metric, "full")
    d = F.col("b") - F.col("a")
    return j.select(metric, "a", "b", d.alias("delta"),
                    F.when(F.col("a") != 0, d / F.col("a") * 100.0).otherwise(F.lit(0.0)).alias("pct_change"),
                    F.when(d > 0.005, "++").when(d > 0, "+").otherwise("-").alias("marker"))


def overlap_at_k(a: DataFrame, b: DataFrame, k: int = 10, user: str = "user_id", item: str = "item_id",
                 rank: str = "rank") -> DataFrame:
    """T5: |top-k(a) & top-k(b)| per user (users present in either list)."""
    ta = a.where(F.col(rank) <= k).select(user, item, F.lit(True).alias("_a"))
    tb = b.where(F.col(rank) <= k).select(user, item, F.lit(True).alias("_b"))
    # The full join keeps the users of either list, so each list is ranked once.
    n = F.count_if(F.col("_a") & F.col("_b"))
    common = ta.join(tb, [user, item], "full").groupBy(user).agg(n.cast("bigint").alias("overlap"))
    return common.select(user, "overlap", (F.col("overlap") / F.lit(float(k))).alias("overlap_ratio"))


def top_k_recommend(scored: DataFrame, seen: DataFrame | None, k: int = 10, user: str = "user_id",
                    item: str = "item_id", score: str = "score") -> DataFrame:
    """Best k per user by score (item id breaks ties), seen items skipped."""
    s = scored.join(seen.select(user, item).distinct(), [user, item], "left_anti") if seen is not None else scored
    return top_k(s, [user], [F.col(score).desc(), F.col(item).asc()], k)
