"""Feature tables: user features (U1-U10), item features (I1-I9), ranking features.

Every family is one ``groupBy`` on its entity plus joins of small per-entity
side tables; grouping runs with map-side partial aggregation, so a heavy user
or item is pre-aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalar import (days_between, first_year_anywhere, release_year_strict,
                                      ts_to_micros)
from kestrel.plans.ordering import competition_rank, dense_rank_desc, group_quantiles


# ---- genres ------------------------------------------------------------------------------

def item_genre_rows(items: DataFrame, vocab: DataFrame) -> DataFrame:
    """(item_id, genre, idx, pos): known genres of each item, pipe-split and trimmed, in title order."""
    exploded = items.select("item_id", F.posexplode(F.split(F.col("genres"), r"\|")).alias("pos", "genre"))
    exploded = exploded.select("item_id", (F.col("pos") + 1).alias("pos"), F.trim("genre").alias("genre"))
    # No broadcast hint: the planner broadcasts the vocabulary when it has measured it as small.
    return exploded.join(vocab, "genre")


# ---- U8 sessions -------------------------------------------------------------------------

def session_stats(df: DataFrame, user: str = "user_id", ts: str = "ts", gap_s: int = 3600) -> DataFrame:
    """session_count and avg_session_length (rows / sessions, 2 decimals) per user.

    A new session starts when the gap to the previous event is > ``gap_s``.
    Instead of a per-user window over every event, events are cut into
    ``gap_s`` buckets: only the first distinct time of a bucket can open a
    session, and it does when the previous bucket is empty or ended more than
    ``gap_s`` earlier.  Work is a partial aggregate per (user, bucket) and an
    equi-join of that aggregate with itself shifted by one bucket -- a heavy
    user is spread over its buckets.
    """
    gap = gap_s * 1_000_000
    us = ts_to_micros(F.col(ts))
    b = df.select(user, us.alias("_us")).withColumn("_b", F.floor(F.col("_us") / F.lit(float(gap))).cast("bigint"))
    per = b.groupBy(user, "_b").agg(F.min("_us").alias("_mn"), F.max("_us").alias("_mx"),
                                    F.count(F.lit(1)).alias("_n"))
    prev = per.select(user, (F.col("_b") + 1).alias("_b"), F.col("_mx").alias("_prev"))
    starts = per.join(prev, [user, "_b"], "left").select(
        user, "_n", F.when(F.col("_prev").isNull() | ((F.col("_mn") - F.col("_prev")) > F.lit(gap)), 1)
        .otherwise(0).alias("_start"))
    agg = starts.groupBy(user).agg(F.sum("_start").alias("session_count"), F.sum("_n").alias("_rows"))
    return agg.select(user, F.col("session_count").cast("bigint"),
                      F.round(F.col("_rows") / F.col("session_count"), 2).alias("avg_session_length"))


# ---- U1-U10 --------------------------------------------------------------------------------

def user_features(ratings: DataFrame, items: DataFrame, vocab: DataFrame, idmap: DataFrame | None = None,
                  gap_s: int = 3600) -> DataFrame:
    """15 user features from (already implicit-filtered) ratings.

    ``idmap`` (user_id, user_idx) keeps mapped users only; ``event_timestamp``
    is the newest rating ("now").  The narrow input is written once to the shared
    checkpoint folder: the seven feature branches then scan that table instead of
    re-deriving it from the base tables.
    """
    from kestrel.session import cut_lineage
    ratings = cut_lineage(ratings.select("user_id", "item_id", "rating", "ts"))
    now = ratings.select(F.max("ts")).scalar()
    base = ratings.groupBy("user_id").agg(
        F.avg("rating").alias("avg_rating"),
        F.count(F.lit(1)).alias("total_interactions"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("rating_std"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.avg(F.when(F.col("rating") >= 4.0, 1.0).otherwise(0.0)).alias("high_rating_ratio"),
        F.min("ts").alias("_first"), F.max("ts").alias("_last"),
        F.count_distinct(F.to_date("ts")).alias("active_days"))
    base = base.select(
        "user_id", "avg_rating", "total_interactions", "rating_std", "min_rating", "max_rating",
        "high_rating_ratio",
        F.greatest(days_between(F.col("_last"), F.col("_first")), F.lit(0.0)).alias("temporal_spread_days"),
        F.greatest(days_between(now, F.col("_last")), F.lit(0.0)).alias("recency_days"),
        F.col("active_days").cast("bigint").alias("active_days"),
        (F.col("total_interactions") / F.greatest(F.col("active_days"), F.lit(1))).alias("interaction_density"),
        now.alias("event_timestamp"))

    # Per (user, genre) counts -- partial aggregation first.
    ug = (ratings.select("user_id", "item_id").join(item_genre_rows(items, vocab), "item_id")
          .groupBy("user_id", "genre", "idx").agg(F.count(F.lit(1)).alias("_c")))
    genres = ug.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("genre_diversity"),
        F.max_by("idx", F.struct(F.col("_c"), -F.col("idx"))).alias("top_genre_idx"))

    sessions = session_stats(ratings, gap_s=gap_s)

    # Competition rank of item counts, averaged per user.
    item_counts = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("_pop"))
    ranks = competition_rank(item_counts, "_pop", "_pop_rank").select("item_id", "_pop_rank")
    bias = (ratings.select("user_id", "item_id").join(ranks, "item_id", "left")
            .groupBy("user_id").agg(F.avg(F.coalesce(F.col("_pop_rank").cast("double"), F.lit(9999.0)))
                                    .alias("popularity_bias")))

    out = (base.join(genres, "user_id", "left").join(sessions, "user_id", "left").join(bias, "user_id", "left")
           .select("user_id", "event_timestamp", "avg_rating", "total_interactions", "rating_std", "min_rating",
                   "max_rating", "high_rating_ratio", "temporal_spread_days", "recency_days", "active_days",
                   "interaction_density",
                   F.coalesce("genre_diversity", F.lit(0)).cast("bigint").alias("genre_diversity"),
                   F.coalesce("top_genre_idx", F.lit(-1)).cast("bigint").alias("top_genre_idx"),
                   F.coalesce("session_count", F.lit(1)).cast("bigint").alias("session_count"),
                   F.coalesce("avg_session_length", F.lit(0.0)).alias("avg_session_length"),
                   F.coalesce("popularity_bias", F.lit(9999.0)).alias("popularity_bias")))
    if idmap is not None:
        out = out.join(idmap, "user_id")
    return out


# ---- I1-I9 ------------------------------------------------------------------------------------

def item_features(ratings: DataFrame, items: DataFrame, vocab: DataFrame,
                  idmap: DataFrame | None = None, threshold: float = 4.0) -> DataFrame:
    """Item features from *all* ratings; catalogue items without ratings are kept and filled.
    The narrow ratings input is materialised once (several branches read it)."""
    from kestrel.session import cut_lineage
    ratings = cut_lineage(ratings.select("item_id", "rating", "ts"))
    now = ratings.select(F.max("ts")).scalar()
    stats = ratings.groupBy("item_id").agg(
        F.avg("rating").alias("avg_item_rating"),
        F.count(F.lit(1)).alias("rating_count"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("rating_std"),
        F.avg(F.when(F.col("rating") >= threshold, 1.0).otherwise(0.0)).alias("high_rating_ratio"),
        F.count_if(F.col("rating") >= threshold).alias("global_popularity"),
        F.greatest(days_between(F.max("ts"), F.min("ts")), F.lit(1.0)).alias("item_active_days"))
    pop = stats.where(F.col("global_popularity") > 0).select("item_id", "global_popularity")
    ranked = competition_rank(pop, "global_popularity", "popularity_rank").select("item_id", "popularity_rank")

    g = item_genre_rows(items, vocab).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("genre_count"), F.min_by("idx", "pos").alias("primary_genre_idx"))
    year = release_year_strict(F.col("title"))
    cat = items.select("item_id", year.alias("release_year"))
    cat = cat.withColumn("item_age_days", F.when(F.col("release_year") == 0, F.lit(0.0)).otherwise(
        (F.greatest(F.year(now) - F.col("release_year"), F.lit(0)) * 365).cast("double")))

    out = (cat.join(g, "item_id", "left").join(stats, "item_id", "left").join(ranked, "item_id", "left")
           .select("item_id", now.alias("event_timestamp"),
                   F.col("release_year").cast("bigint").alias("release_year"),
                   F.coalesce("genre_count", F.lit(0)).cast("bigint").alias("genre_count"),
                   F.coalesce("primary_genre_idx", F.lit(-1)).cast("bigint").alias("primary_genre_idx"),
                   "item_age_days",
                   F.coalesce("avg_item_rating", F.lit(0.0)).alias("avg_item_rating"),
                   F.coalesce("rating_count", F.lit(0)).cast("bigint").alias("rating_count"),
                   F.coalesce("rating_std", F.lit(0.0)).alias("rating_std"),
                   F.coalesce("high_rating_ratio", F.lit(0.0)).alias("high_rating_ratio"),
                   F.coalesce("global_popularity", F.lit(0)).cast("bigint").alias("global_popularity"),
                   F.coalesce("popularity_rank", F.lit(99999)).cast("bigint").alias("popularity_rank"),
                   F.when(F.col("global_popularity") > 0, F.lit(1.0) / F.log1p("global_popularity"))
                   .otherwise(F.lit(1.0)).alias("niche_score"),
                   F.coalesce("item_active_days", F.lit(1.0)).alias("item_active_days")))
    out = out.withColumn("avg_ratings_per_day",
                         F.col("rating_count") / F.greatest(F.col("item_active_days"), F.lit(1.0)))
    if idmap is not None:
        out = out.join(idmap, "item_id")
    return out


# ---- R1-R9 --------------------------------------------------------------------------------------

def rank_user_features(ratings: DataFrame, seq_lengths: DataFrame | None = None) -> DataFrame:
    """Training-family user features; active_days = (last - first) / 86400."""
    now = ratings.select(F.max("ts")).scalar()
    s = ratings.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("user_rating_count"), F.avg("rating").alias("user_avg_rating"),
        F.min("rating").alias("user_min_rating"), F.max("rating").alias("user_max_rating"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("user_rating_std"),
        F.max("ts").alias("user_last_timestamp"), F.min("ts").alias("user_first_timestamp"))
    s = s.withColumn("user_active_days", days_between(F.col("user_last_timestamp"), F.col("user_first_timestamp")))
    s = s.withColumn("user_days_since_last", days_between(now, F.col("user_last_timestamp")))
    if seq_lengths is not None:
        s = (s.join(seq_lengths, "user_id", "left")
             .withColumn("user_sequence_length", F.coalesce("user_sequence_length", F.lit(0)).cast("bigint")))
    return s


NO_GENRES = "(no genres listed)"


def genre_column(name) -> F.Column:
    """Column name of a genre's one-hot: blanks and hyphens become underscores."""
    return F.concat(F.lit("genre_"), F.translate(name, " -", "__"))


ANCHOR = 32     # characters of a name that are searched for; longer names are verified where these match
PIECE = 1000    # characters of a token that are cut into substrings at a time


def item_genres_long(items: DataFrame) -> DataFrame:
    """(item_id, genre): every catalogue genre whose name occurs in the item's genres string.

    The substring test runs once per distinct '|'-separated token.  A token's substrings of
    the lengths that names (or their first 32 characters) have are equi-joined with the
    names, so the work is linear in the token's length; long tokens are cut into overlapping
    pieces, and a long name is verified in the few tokens that hold its beginning.  At most
    32 lengths, as one array, leave the executors; no vocabulary does.
    """
    own = items.select("item_id", F.explode(F.split("genres", r"\|")).alias("token"))
    # A digest stands for the token wherever it is multiplied.
    tokens = own.select("token").distinct().withColumn("id", F.md5(F.col("token").cast("binary")))
    names = tokens.where((F.col("token") != NO_GENRES) & (F.col("token") != "")).select(
        F.col("token").alias("genre"), F.substring("token", 1, ANCHOR).alias("anchor"))
    lengths = names.agg(F.sort_array(F.collect_set(F.length("anchor")))).scalar()
    pieces = tokens.where(F.length("token") > 0).select(
        "id", F.explode(F.transform(F.sequence(F.lit(1), F.length("token"), F.lit(PIECE)),
                                    lambda at: F.col("token").substr(at, F.lit(PIECE + ANCHOR - 1)))).alias("_piece"))
    starts = pieces.select("id", "_piece", F.explode(F.sequence(F.lit(1), F.least(F.length("_piece"), F.lit(PIECE)))).alias("_s"),
                           lengths.alias("_lengths"))
    parts = starts.select("id", F.explode(F.transform(F.filter(
        "_lengths", lambda n: F.col("_s") + n - 1 <= F.length("_piece")),
        lambda n: F.col("_piece").substr(F.col("_s"), n))).alias("anchor")).distinct()
    found = (parts.join(names, "anchor").join(tokens, "id")
             .where((F.length("genre") <= ANCHOR) | F.contains("token", "genre")).select("token", "genre"))
    return own.join(found, "token").select("item_id", "genre").distinct()


def genre_wide(long: DataFrame, vocabulary: list) -> DataFrame:
    """R4 in wide form: per item one 0/1 column per genre of a declared vocabulary, in its order.

    The columns are those of the vocabulary whatever the data hold: a trained model's schema
    does not move with the catalogue.  One partial aggregate, no pivot over found values."""
    return long.groupBy("item_id").agg(*[
        F.max(F.when(F.col("genre") == g, 1).otherwise(0)).alias(genre_name(g)) for g in vocabulary])


def genre_name(name: str) -> str:
    return "genre_" + name.replace(" ", "_").replace("-", "_")


def genre_onehot(items: DataFrame) -> DataFrame:
    """R4 in long form: (item_id, title, genre_name, item_num_genres), one row per item and genre;
    an item without genres has one row with a null name and the count 0."""
    long = item_genres_long(items)
    n = long.groupBy("item_id").agg(F.count(F.lit(1)).alias("item_num_genres"))
    return (items.select("item_id", "title").join(n, "item_id", "left").join(long, "item_id", "left")
            .select("item_id", "title", genre_column(F.col("genre")).alias("genre_name"),
                    F.coalesce("item_num_genres", F.lit(0)).cast("bigint").alias("item_num_genres")))


def rank_item_features(ratings: DataFrame, items: DataFrame, genres: DataFrame | None = None) -> DataFrame:
    """Training-family item features: stats over ratings, first '(dddd)' year, number of genres,
    dense popularity rank.  Items without metadata get year 0 and no genres; the genres
    themselves are the long table ``item_genres_long`` (given as ``genres``, or made here)."""
    now = ratings.select(F.max("ts")).scalar()
    s = ratings.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("item_rating_count"), F.avg("rating").alias("item_avg_rating"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("item_rating_std"),
        F.max("ts").alias("_last"), F.min("ts").alias("_first"))
    s = s.select("item_id", "item_rating_count", "item_avg_rating", "item_rating_std",
                 F.col("item_rating_count").alias("item_popularity"),
                 F.log1p("item_rating_count").alias("item_log_popularity"),
                 days_between(now, F.col("_last")).alias("item_days_since_last_rating"),
                 days_between(F.col("_last"), F.col("_first")).alias("item_active_days"))
    rated = items.join(s.select("item_id"), "item_id", "left_semi")
    long = item_genres_long(items) if genres is None else genres
    n = long.groupBy("item_id").agg(F.count(F.lit(1)).alias("item_num_genres"))
    meta = rated.select("item_id", first_year_anywhere(F.col("title")).alias("item_year")).join(n, "item_id", "left")
    out = s.join(meta, "item_id", "left").select(
        *s.columns, F.coalesce("item_year", F.lit(0)).cast("bigint").alias("item_year"),
        F.coalesce("item_num_genres", F.lit(0)).cast("bigint").alias("item_num_genres"))
    return dense_rank_desc(out, "item_rating_count", "item_popularity_rank")


def popularity_distribution(df: DataFrame, item: str = "item_id", pad: int = 0) -> DataFrame:
    """P(item) = count / total (PAD excluded), plus count / max."""
    c = df.where(F.col(item) != pad).groupBy(item).agg(F.count(F.lit(1)).alias("count"))
    total = c.select(F.sum("count")).scalar()
    mx = c.select(F.max("count")).scalar()
    return c.select(item, "count", (F.col("count") / total).alias("prob"),
                    (F.col("count") / mx).alias("pop_norm"))


def describe(df: DataFrame, cols: list, digits: int = 6) -> DataFrame:
    """count / mean / std / min / quartiles / max per column, long form (one row per feature).

    All features in one pass: the columns are unpivoted and grouped by name.
    Quartiles are exact and interpolated: values are numbered within their feature over
    range partitions, so no task holds a feature's values.
    """
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_s")
    ).select("_s.feature", "_s.v")
    agg = stacked.groupBy("feature").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = group_quantiles(stacked, "feature", "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return agg.join(q, "feature", "left").select(
        "feature", "count", *[F.round(c, digits).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def session_starts(df: DataFrame, user: str = "user_id", ts: str = "ts", gap_s: int = 3600) -> DataFrame:
    """(user, session_start): the first event time of every session (gap > ``gap_s`` opens one).
    Same bucket argument as ``session_stats``; no per-user window over events."""
    gap = gap_s * 1_000_000
    b = df.select(user, F.col(ts).alias("_t")).withColumn(
        "_b", F.floor(ts_to_micros(F.col("_t")) / F.lit(float(gap))).cast("bigint"))
    per = b.groupBy(user, "_b").agg(F.min("_t").alias("_mn"), F.max("_t").alias("_mx"))
    prev = per.select(user, (F.col("_b") + 1).alias("_b"), F.col("_mx").alias("_prev"))
    j = per.join(prev, [user, "_b"], "left")
    opens = F.col("_prev").isNull() | ((ts_to_micros(F.col("_mn")) - ts_to_micros(F.col("_prev"))) > F.lit(gap))
    return j.where(opens).select(user, F.col("_mn").alias("session_start"))


def assign_sessions(df: DataFrame, user: str = "user_id", ts: str = "ts", gap_s: int = 3600) -> DataFrame:
    """Every event with its session_start (the newest session start <= its time), via the as-of join."""
    from kestrel.operators.feature_store import pit_join
    starts = session_starts(df, user, ts, gap_s).withColumnRenamed("session_start", "event_timestamp")
    out = pit_join(df, starts, user, [], fact_ts=ts, ttl_seconds=10 ** 12, fill=None)
    return out.withColumnRenamed("event_timestamp", "session_start")
