"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement reads the driver tables (pre-registered views) and rebuilds the
model tables with the same adapter rules as ``kestrel.sources.adapters``.
"""

from __future__ import annotations

RATINGS = """SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, l.l_quantity / 10.0 AS rating,
       l.l_shipdate AS ts, l.l_orderkey * 100 + l.l_linenumber AS tie
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

IMPLICIT = RATINGS + " WHERE l.l_quantity >= 40"

ITEMS = """SELECT p_partkey AS item_id, p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')' AS title,
       concat_ws('|', p_type, p_brand) AS genres FROM part"""

VOCAB = """SELECT genre, CAST(row_number() OVER (ORDER BY grp, genre) - 1 AS BIGINT) AS idx
  FROM (SELECT genre, min(grp) AS grp FROM (
          SELECT 0 AS grp, p_type AS genre FROM part UNION ALL SELECT 1 AS grp, p_brand AS genre FROM part)
        WHERE genre IS NOT NULL GROUP BY genre)"""

ITEM_GENRES = """SELECT i.item_id, g.genre, v.idx, g.pos
  FROM (""" + ITEMS + """) i,
       LATERAL (SELECT trim(x.genre) AS genre, x.pos FROM
                  (SELECT unnest(string_split(i.genres, '|')) AS genre,
                          generate_subscripts(string_split(i.genres, '|'), 1) AS pos) x) g
  JOIN (""" + VOCAB + """) v ON v.genre = g.genre"""


def kcore_ctes(src: str, prefix: str = "kc", min_user: int = 5, min_item: int = 5, rounds: int = 11):
    """Unrolled k-core: returns (list of CTE definitions, name of the final CTE)."""
    ctes = [f"{prefix}0 AS ({src})"]
    for i in range(1, rounds + 1):
        prev = f"{prefix}{i - 1}"
        ctes.append(f"{prefix}u{i} AS (SELECT * FROM {prev} WHERE user_id IN "
                    f"(SELECT user_id FROM {prev} GROUP BY user_id HAVING count(*) >= {min_user}))")
        ctes.append(f"{prefix}{i} AS (SELECT * FROM {prefix}u{i} WHERE item_id IN "
                    f"(SELECT item_id FROM {prefix}u{i} GROUP BY item_id HAVING count(*) >= {min_item}))")
    return ctes, f"{prefix}{rounds}"


def with_(ctes, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _kcore_holdout():
    ctes, core = kcore_ctes(IMPLICIT)
    ctes += [
        f"lastrow AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM {core})",
        "target AS (SELECT user_id, item_id FROM lastrow WHERE rn = 1)",
        "hist AS (SELECT user_id, item_id, ts, tie FROM lastrow WHERE rn > 1)",
    ]
    return ctes


def metric_bundle_sql(ranks_cte: str, ks=(5, 10, 20)) -> str:
    kv = ", ".join(f"({k})" for k in ks)
    return f"""SELECT CAST(ks.k AS BIGINT) AS k, count(*) AS n_users,
  round(avg(CASE WHEN rnk <= ks.k THEN 1.0 ELSE 0.0 END), 6) AS hr,
  round(avg(CASE WHEN rnk <= ks.k THEN 1.0 / log2(rnk + 1.0) ELSE 0.0 END), 6) AS ndcg,
  round(avg(CASE WHEN rnk <= ks.k THEN 1.0 / rnk ELSE 0.0 END), 6) AS mrr,
  round(avg(CASE WHEN rnk <= ks.k THEN 1.0 / ks.k ELSE 0.0 END), 6) AS precision,
  round(avg(CAST(rnk AS DOUBLE)), 6) AS mean_rank,
  round(quantile_cont(CAST(rnk AS DOUBLE), 0.5), 6) AS median_rank
FROM {ranks_cte}, (VALUES {kv}) ks(k) GROUP BY ks.k"""


ORACLE: dict[str, str] = {}

# ---- flagship: implicit filter -> k-core -> hold out last -> most-popular recommender -> HR/NDCG/MRR
ORACLE["popularity_eval"] = with_(_kcore_holdout() + [
    "pop AS (SELECT item_id, count(*) AS pop FROM hist GROUP BY item_id)",
    "tp AS (SELECT t.user_id, t.item_id, coalesce(p.pop, 0) AS pt FROM target t LEFT JOIN pop p USING (item_id))",
    """ranks AS (SELECT tp.user_id, 1 + (SELECT count(*) FROM pop
                 WHERE pop.pop > tp.pt AND pop.item_id NOT IN (SELECT h.item_id FROM hist h WHERE h.user_id = tp.user_id)) AS rnk
               FROM tp)""",
], metric_bundle_sql("ranks"))

# ---- step 1: preparation -------------------------------------------------------------
_KC, _CORE = kcore_ctes(IMPLICIT)

ORACLE["k_core"] = with_(_KC, f"SELECT user_id, item_id, rating, ts, tie FROM {_CORE}")

ORACLE["dense_encode"] = with_(_KC, f"""
SELECT 'user' AS kind, user_id AS raw_id, CAST(row_number() OVER (ORDER BY user_id) AS BIGINT) AS idx
  FROM (SELECT DISTINCT user_id FROM {_CORE})
UNION ALL
SELECT 'item' AS kind, item_id AS raw_id, CAST(row_number() OVER (ORDER BY item_id) AS BIGINT) AS idx
  FROM (SELECT DISTINCT item_id FROM {_CORE})""")

ORACLE["dataset_stats"] = with_(_KC, f"""
SELECT n_users, n_items, n_interactions,
  round(1.0 - n_interactions / (CAST(n_users AS DOUBLE) * n_items), 6) AS sparsity,
  round(n_interactions / (CAST(n_users AS DOUBLE) * n_items), 6) AS density,
  round(n_interactions / CAST(n_users AS DOUBLE), 6) AS avg_per_user,
  round(n_interactions / CAST(n_items AS DOUBLE), 6) AS avg_per_item,
  n_users + 1 AS n_users_with_pad, n_items + 1 AS n_items_with_pad
FROM (SELECT count(*) AS n_interactions, count(DISTINCT user_id) AS n_users,
             count(DISTINCT item_id) AS n_items FROM {_CORE})""")

ORACLE["sequences_padded"] = with_(_KC + [
    f"r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM {_CORE})"], """
SELECT user_id, repeat('0,', CAST(50 - count(*) AS INTEGER)) || string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY ts, tie) AS seq,
       count(*) AS n_recent
FROM r WHERE rn <= 50 GROUP BY user_id""")

ORACLE["sequence_positions"] = with_(_KC, f"""
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, tie) AS BIGINT) AS pos, item_id, ts
FROM {_CORE}""")

ORACLE["leave_last_out"] = with_(_KC + [
    f"r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM {_CORE})"], """
SELECT CASE WHEN rn = 1 THEN 'test' WHEN rn = 2 THEN 'val' ELSE 'train' END AS split, user_id, item_id, ts, tie FROM r""")

ORACLE["serving_history"] = with_(_KC + [
    f"""r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn,
                count(*) OVER (PARTITION BY user_id) AS n FROM {_CORE})"""], """
SELECT user_id, item_id, ts, tie FROM r WHERE rn > 1 OR n = 1""")

ORACLE["next_item_pairs"] = with_(_KC + [
    f"r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM {_CORE})",
    "k AS (SELECT * FROM r WHERE rn <= 51)",
    "n AS (SELECT user_id, max(rn) AS n FROM k GROUP BY user_id)"], """
SELECT a.user_id, CAST(n.n - a.rn + 1 AS BIGINT) AS pos, a.item_id AS input_item, b.item_id AS target_item
FROM k a JOIN k b ON a.user_id = b.user_id AND b.rn = a.rn - 1 JOIN n ON n.user_id = a.user_id""")

ORACLE["prefix_samples"] = with_(_KC + [
    f"p AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, tie) AS pos FROM {_CORE})"], """
SELECT t.user_id, CAST(t.pos AS BIGINT) AS pos, t.item_id AS target_item, count(*) AS prefix_len,
       string_agg(CAST(h.item_id AS VARCHAR), ',' ORDER BY h.pos) AS prefix
FROM p t JOIN p h ON h.user_id = t.user_id AND h.pos BETWEEN t.pos - 50 AND t.pos - 1
WHERE t.pos >= 2 GROUP BY t.user_id, t.pos, t.item_id""")

ORACLE["train_window"] = with_(_KC + [
    f"r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM {_CORE})",
    "tr AS (SELECT user_id, item_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, tie) AS pos FROM r WHERE rn > 2)",
    f"""fr AS (SELECT user_id, item_id, ts, rating FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id, item_id, ts ORDER BY tie) AS q FROM ({RATINGS})) WHERE q = 1)"""], """
SELECT tr.user_id, tr.item_id, tr.ts, CAST(tr.pos AS BIGINT) AS pos, coalesce(fr.rating, 0.0) AS rating
FROM tr LEFT JOIN fr USING (user_id, item_id, ts)""")

ORACLE["user_item_sets"] = with_(_KC, f"""
SELECT count(*) AS n_users, min(n) AS min_items, max(n) AS max_items, round(avg(n), 6) AS mean_items, sum(n) AS total_pairs
FROM (SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, item_id FROM {_CORE} WHERE item_id <> 0) GROUP BY user_id)""")

ORACLE["recent_history"] = with_(_KC + [
    f"r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM {_CORE})",
    f"it AS ({ITEMS})"], """
SELECT r.user_id, CAST(r.rn AS BIGINT) AS position, r.item_id, r.ts, coalesce(it.title, 'Unknown') AS title
FROM r LEFT JOIN it USING (item_id) WHERE r.rn <= 10""")

ORACLE["vocab_filter_binarize"] = with_(_KC + [f"raw AS ({IMPLICIT})"], f"""
SELECT user_id, item_id, ts, tie, 1 AS interaction FROM raw
WHERE user_id IN (SELECT user_id FROM {_CORE}) AND item_id IN (SELECT item_id FROM {_CORE})""")

# ---- step 2: features ------------------------------------------------------------------------
IG = """SELECT item_id, trim(genre) AS genre, pos FROM (
          SELECT item_id, unnest(string_split(genres, '|')) AS genre,
                 unnest(range(1, len(string_split(genres, '|')) + 1)) AS pos FROM it)"""


def _days(later, earlier):
    return f"((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0)"


_USER_FEAT = [f"r AS ({IMPLICIT})", f"it AS ({ITEMS})", f"v AS ({VOCAB})",
              f"ig AS (SELECT x.item_id, x.genre, v.idx, x.pos FROM ({IG}) x JOIN v ON v.genre = x.genre)",
              "nowt AS (SELECT max(ts) AS now FROM r)",
              f"""base AS (SELECT user_id, avg(rating) AS avg_rating, count(*) AS total_interactions,
                   coalesce(stddev_samp(rating), 0.0) AS rating_std, min(rating) AS min_rating, max(rating) AS max_rating,
                   avg(CASE WHEN rating >= 4.0 THEN 1.0 ELSE 0.0 END) AS high_rating_ratio,
                   min(ts) AS f, max(ts) AS l, count(DISTINCT CAST(ts AS DATE)) AS active_days FROM r GROUP BY user_id)""",
              "ug AS (SELECT r.user_id, ig.genre, ig.idx, count(*) AS c FROM r JOIN ig USING (item_id) GROUP BY 1, 2, 3)",
              """gen AS (SELECT user_id, count(*) AS genre_diversity,
                   max(CASE WHEN rn = 1 THEN idx END) AS top_genre_idx FROM (
                   SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, idx ASC) AS rn FROM ug) GROUP BY user_id)""",
              """ses AS (SELECT user_id, sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 3600000000 THEN 1 ELSE 0 END) AS sc,
                   count(*) AS n FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM r) GROUP BY user_id)""",
              "ipop AS (SELECT item_id, rank() OVER (ORDER BY cnt DESC) AS pr FROM (SELECT item_id, count(*) AS cnt FROM r GROUP BY item_id))",
              "bias AS (SELECT r.user_id, avg(coalesce(CAST(ipop.pr AS DOUBLE), 9999.0)) AS popularity_bias FROM r LEFT JOIN ipop USING (item_id) GROUP BY r.user_id)",
              f"""uf AS (SELECT b.user_id, nowt.now AS event_timestamp, round(b.avg_rating, 6) AS avg_rating, b.total_interactions,
                   round(b.rating_std, 6) AS rating_std, round(b.min_rating, 6) AS min_rating, round(b.max_rating, 6) AS max_rating,
                   round(b.high_rating_ratio, 6) AS high_rating_ratio,
                   round(greatest({_days('b.l', 'b.f')}, 0.0), 6) AS temporal_spread_days,
                   round(greatest({_days('nowt.now', 'b.l')}, 0.0), 6) AS recency_days,
                   b.active_days, round(b.total_interactions / greatest(b.active_days, 1), 6) AS interaction_density,
                   CAST(coalesce(g.genre_diversity, 0) AS BIGINT) AS genre_diversity,
                   CAST(coalesce(g.top_genre_idx, -1) AS BIGINT) AS top_genre_idx,
                   CAST(coalesce(s.sc, 1) AS BIGINT) AS session_count,
                   round(coalesce(round(s.n / s.sc, 2), 0.0), 6) AS avg_session_length,
                   round(coalesce(p.popularity_bias, 9999.0), 6) AS popularity_bias
                 FROM base b CROSS JOIN nowt LEFT JOIN gen g USING (user_id) LEFT JOIN ses s USING (user_id)
                 LEFT JOIN bias p USING (user_id))"""]

ORACLE["user_features_full"] = with_(_KC + _USER_FEAT + [
    f"umap AS (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) AS BIGINT) AS user_idx FROM (SELECT DISTINCT user_id FROM {_CORE}))"],
    "SELECT uf.*, umap.user_idx FROM uf JOIN umap USING (user_id)")

ORACLE["user_sessions"] = """
SELECT user_id, CAST(sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 3600000000 THEN 1 ELSE 0 END) AS BIGINT) AS session_count,
       round(count(*) / sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 3600000000 THEN 1 ELSE 0 END), 2) AS avg_session_length
FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events) GROUP BY user_id"""

ORACLE["item_features"] = with_(_KC + [
    f"r AS ({RATINGS})", f"it AS ({ITEMS})", f"v AS ({VOCAB})",
    f"ig AS (SELECT x.item_id, x.genre, v.idx, x.pos FROM ({IG}) x JOIN v ON v.genre = x.genre)",
    "nowt AS (SELECT max(ts) AS now FROM r)",
    f"""st AS (SELECT item_id, avg(rating) AS a, count(*) AS c, coalesce(stddev_samp(rating), 0.0) AS s,
          avg(CASE WHEN rating >= 4.0 THEN 1.0 ELSE 0.0 END) AS h, count(*) FILTER (WHERE rating >= 4.0) AS gp,
          greatest({_days('max(ts)', 'min(ts)')}, 1.0) AS ad FROM r GROUP BY item_id)""",
    "rk AS (SELECT item_id, rank() OVER (ORDER BY gp DESC) AS pr FROM st WHERE gp > 0)",
    "g AS (SELECT item_id, count(*) AS gc, arg_min(idx, pos) AS pg FROM ig GROUP BY item_id)",
    """cat AS (SELECT item_id, CASE WHEN yr BETWEEN 1888 AND 2030 THEN yr ELSE 0 END AS ry FROM (
          SELECT item_id, CAST(nullif(regexp_extract(trim(title), '\\((\\d{4})\\)\\s*$', 1), '') AS INTEGER) AS yr FROM it))""",
    f"imap AS (SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) AS BIGINT) AS item_idx FROM (SELECT DISTINCT item_id FROM {_CORE}))"], """
SELECT c.item_id, nowt.now AS event_timestamp, CAST(coalesce(c.ry, 0) AS BIGINT) AS release_year,
  CAST(coalesce(g.gc, 0) AS BIGINT) AS genre_count, CAST(coalesce(g.pg, -1) AS BIGINT) AS primary_genre_idx,
  round(CASE WHEN coalesce(c.ry, 0) = 0 THEN 0.0 ELSE CAST(greatest(year(nowt.now) - c.ry, 0) * 365 AS DOUBLE) END, 6) AS item_age_days,
  round(coalesce(st.a, 0.0), 6) AS avg_item_rating, CAST(coalesce(st.c, 0) AS BIGINT) AS rating_count,
  round(coalesce(st.s, 0.0), 6) AS rating_std, round(coalesce(st.h, 0.0), 6) AS high_rating_ratio,
  CAST(coalesce(st.gp, 0) AS BIGINT) AS global_popularity, CAST(coalesce(rk.pr, 99999) AS BIGINT) AS popularity_rank,
  round(CASE WHEN st.gp > 0 THEN 1.0 / ln(1 + st.gp) ELSE 1.0 END, 6) AS niche_score,
  round(coalesce(st.ad, 1.0), 6) AS item_active_days,
  round(coalesce(st.c, 0) / greatest(coalesce(st.ad, 1.0), 1.0), 6) AS avg_ratings_per_day,
  imap.item_idx
FROM cat c CROSS JOIN nowt LEFT JOIN g USING (item_id) LEFT JOIN st USING (item_id) LEFT JOIN rk USING (item_id)
JOIN imap USING (item_id)""")

ORACLE["item_popularity_rank"] = f"""
SELECT item_id, global_popularity, CAST(rank() OVER (ORDER BY global_popularity DESC) AS BIGINT) AS popularity_rank
FROM (SELECT item_id, count(*) AS global_popularity FROM ({IMPLICIT}) GROUP BY item_id)"""

_TRAIN = _KC + [
    f"r0 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM {_CORE})",
    "tr AS (SELECT user_id, item_id, ts FROM r0 WHERE rn > 2)",
    f"""fr AS (SELECT user_id, item_id, ts, rating FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id, item_id, ts ORDER BY tie) AS q FROM ({RATINGS})) WHERE q = 1)""",
    "tw AS (SELECT tr.user_id, tr.item_id, tr.ts, coalesce(fr.rating, 0.0) AS rating FROM tr LEFT JOIN fr USING (user_id, item_id, ts))",
    "nowt AS (SELECT max(ts) AS now FROM tw)"]

ORACLE["rank_user_features"] = with_(_TRAIN, f"""
SELECT user_id, count(*) AS user_rating_count, round(avg(rating), 6) AS user_avg_rating,
  round(min(rating), 6) AS user_min_rating, round(max(rating), 6) AS user_max_rating,
  round(coalesce(stddev_samp(rating), 0.0), 6) AS user_rating_std, max(ts) AS user_last_timestamp, min(ts) AS user_first_timestamp,
  round({_days('max(ts)', 'min(ts)')}, 6) AS user_active_days,
  round({_days('any_value(nowt.now)', 'max(ts)')}, 6) AS user_days_since_last,
  count(*) AS user_sequence_length
FROM tw CROSS JOIN nowt GROUP BY user_id""")

_OH = """oh AS (SELECT it.item_id, gv.genre FROM it,
       (SELECT DISTINCT unnest(string_split(genres, '|')) AS genre FROM it) gv
 WHERE gv.genre <> '(no genres listed)' AND gv.genre <> '' AND contains(it.genres, gv.genre)),
ohn AS (SELECT item_id, count(*) AS item_num_genres FROM oh GROUP BY item_id)"""

ORACLE["genre_onehot"] = with_([f"it AS ({ITEMS})", _OH], """
SELECT it.item_id, it.title, 'genre_' || replace(replace(oh.genre, ' ', '_'), '-', '_') AS genre_name,
  coalesce(ohn.item_num_genres, 0) AS item_num_genres
FROM it LEFT JOIN oh USING (item_id) LEFT JOIN ohn USING (item_id)""")

ORACLE["rank_item_features"] = with_(_TRAIN + [
    f"it AS ({ITEMS})", _OH,
    f"""st AS (SELECT item_id, count(*) AS item_rating_count, avg(rating) AS item_avg_rating,
          coalesce(stddev_samp(rating), 0.0) AS item_rating_std, max(ts) AS l, min(ts) AS f FROM tw GROUP BY item_id)"""], f"""
SELECT st.item_id, st.item_rating_count, round(st.item_avg_rating, 6) AS item_avg_rating,
  round(st.item_rating_std, 6) AS item_rating_std, st.item_rating_count AS item_popularity,
  round(ln(1 + st.item_rating_count), 6) AS item_log_popularity,
  round({_days('nowt.now', 'st.l')}, 6) AS item_days_since_last_rating,
  round({_days('st.l', 'st.f')}, 6) AS item_active_days,
  CAST(coalesce(CAST(nullif(regexp_extract(it.title, '\\((\\d{{4}})\\)', 1), '') AS INTEGER), 0) AS BIGINT) AS item_year,
  coalesce(ohn.item_num_genres, 0) AS item_num_genres,
  CAST(dense_rank() OVER (ORDER BY st.item_rating_count DESC) AS BIGINT) AS item_popularity_rank
FROM st CROSS JOIN nowt LEFT JOIN it USING (item_id) LEFT JOIN ohn USING (item_id)""")

ORACLE["popularity_distribution"] = with_(_KC, f"""
SELECT item_id, count, round(count / sum(count) OVER (), 6) AS prob, round(count / max(count) OVER (), 6) AS pop_norm
FROM (SELECT item_id, count(*) AS count FROM {_CORE} WHERE item_id <> 0 GROUP BY item_id)""")

_UF_COLS = ["avg_rating", "total_interactions", "rating_std", "min_rating", "max_rating", "high_rating_ratio",
            "temporal_spread_days", "recency_days", "active_days", "interaction_density", "genre_diversity",
            "top_genre_idx", "session_count", "avg_session_length", "popularity_bias"]

ORACLE["feature_summary"] = with_(_USER_FEAT + [
    "lng AS (UNPIVOT (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _UF_COLS) +
    " FROM uf) ON " + ", ".join(_UF_COLS) + " INTO NAME feature VALUE v)"], """
SELECT feature, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min,
  round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75,
  round(max(v), 6) AS max
FROM lng GROUP BY feature""")

# ---- step 3: feature store ---------------------------------------------------------------------
SNAPS = [
    """daily AS (SELECT user_id, CAST(ts AS DATE) AS day, max(ts) AS event_timestamp, count(*) AS n_events,
        count(*) FILTER (WHERE event_type = 'click') AS n_clicks, count(*) FILTER (WHERE event_type = 'purchase') AS n_purchases,
        sum(value) AS value_sum FROM events GROUP BY 1, 2)""",
    """snaps AS (SELECT user_id, event_timestamp, CAST(sum(n_events) OVER w AS BIGINT) AS cum_events,
        CAST(sum(n_clicks) OVER w AS BIGINT) AS cum_clicks, CAST(sum(n_purchases) OVER w AS BIGINT) AS cum_purchases,
        round(sum(value_sum) OVER w, 6) AS cum_value
      FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""]


def _pit(ttl_us: int) -> str:
    ok = f"(s.event_timestamp IS NOT NULL AND epoch_us(s.event_timestamp) >= epoch_us(f.ts) - {ttl_us})"
    return with_(SNAPS, f"""
SELECT f.event_id, f.user_id, f.ts, f.event_type, CASE WHEN {ok} THEN s.event_timestamp END AS event_timestamp,
  CASE WHEN {ok} THEN s.cum_events ELSE 0 END AS cum_events, CASE WHEN {ok} THEN s.cum_clicks ELSE 0 END AS cum_clicks,
  CASE WHEN {ok} THEN s.cum_purchases ELSE 0 END AS cum_purchases, CASE WHEN {ok} THEN s.cum_value ELSE 0.0 END AS cum_value
FROM events f ASOF LEFT JOIN snaps s ON f.user_id = s.user_id AND f.ts >= s.event_timestamp""")


ORACLE["pit_join"] = _pit(30 * 86400 * 1_000_000)
ORACLE["pit_join_ttl_1d"] = _pit(86400 * 1_000_000)

_EVENT_ITEM = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
ITEM_SNAPS = [x.replace("user_id", "item_id").replace("daily AS", "item_daily AS").replace("FROM daily", "FROM item_daily")
              .replace("snaps AS", "item_snaps AS").replace("FROM events", f"FROM (SELECT *, {_EVENT_ITEM} AS item_id FROM events) "
              "WHERE item_id IS NOT NULL") for x in SNAPS]


def _as_of(alias: str, prefix: str = "") -> str:
    """The counters of a 30-day as-of match, 0 where there is none."""
    ok = f"({alias}.event_timestamp IS NOT NULL AND epoch_us({alias}.event_timestamp) >= epoch_us(f.ts) - {30 * 86400 * 1_000_000})"
    return ", ".join(f"CASE WHEN {ok} THEN {alias}.{c} ELSE 0 END AS {prefix}{c}"
                     for c in ("cum_events", "cum_clicks", "cum_purchases", "cum_value"))


ORACLE["pit_join_items"] = with_(ITEM_SNAPS, f"""
SELECT f.event_id, f.user_id, f.item_id, f.ts, CASE WHEN epoch_us(s.event_timestamp) >= epoch_us(f.ts) - {30 * 86400 * 1_000_000}
  THEN s.event_timestamp END AS event_timestamp, {_as_of('s')}
FROM (SELECT *, {_EVENT_ITEM} AS item_id FROM events) f ASOF LEFT JOIN item_snaps s ON f.item_id = s.item_id AND f.ts >= s.event_timestamp""")

ORACLE["pit_training_rows"] = with_(SNAPS + ITEM_SNAPS, f"""
SELECT f.event_id, f.user_id, f.item_id, f.ts, f.label, {_as_of('u', 'user_')}, {_as_of('i', 'item_')}
FROM (SELECT event_id, user_id, {_EVENT_ITEM} AS item_id, ts, CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS label
      FROM events WHERE event_type IN ('click', 'purchase', 'view')) f
ASOF LEFT JOIN snaps u ON f.user_id = u.user_id AND f.ts >= u.event_timestamp
ASOF LEFT JOIN item_snaps i ON f.item_id = i.item_id AND f.ts >= i.event_timestamp""")

ORACLE["materialize_latest"] = with_(SNAPS, """
SELECT user_id, event_timestamp, cum_events, cum_clicks, cum_purchases, cum_value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC) AS rn FROM snaps) WHERE rn = 1""")

_USER_DEFAULTS = [("avg_rating", 3.5), ("total_interactions", 0.0), ("rating_std", 0.5), ("min_rating", 1.0),
                  ("max_rating", 5.0), ("high_rating_ratio", 0.5), ("active_days", 1.0), ("interaction_density", 1.0),
                  ("temporal_spread_days", 0.0), ("recency_days", 365.0), ("session_count", 1.0),
                  ("avg_session_length", 1.0), ("genre_diversity", 5.0), ("top_genre_idx", 4.0),
                  ("popularity_bias", 5000.0)]

ORACLE["entity_lookup_defaults"] = with_(_USER_FEAT, "SELECT c.c_custkey AS user_id, uf.user_id IS NOT NULL AS found, " +
    ", ".join(f"round(coalesce(CAST(uf.{c} AS DOUBLE), {v}), 6) AS {c}" for c, v in _USER_DEFAULTS) +
    " FROM customer c LEFT JOIN uf ON uf.user_id = c.c_custkey")

_SNAP_COLS = ["cum_events", "cum_clicks", "cum_purchases", "cum_value"]
_DRIFT = SNAPS + [
    "cut AS (SELECT (min(epoch_us(event_timestamp)) + max(epoch_us(event_timestamp))) // 2 AS c FROM snaps)",
    "lng AS (SELECT feature, v, CASE WHEN epoch_us(s.event_timestamp) < cut.c THEN 'e' ELSE 'a' END AS side FROM "
    "(UNPIVOT (SELECT event_timestamp, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _SNAP_COLS) +
    " FROM snaps) ON " + ", ".join(_SNAP_COLS) + " INTO NAME feature VALUE v) s CROSS JOIN cut WHERE v IS NOT NULL)",
    "rng AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM lng GROUP BY feature)",
    """cnt AS (SELECT l.feature, l.side, CAST(least(floor((l.v - r.lo) / ((r.hi - r.lo) / 10.0)), 9) AS INTEGER) AS bin, count(*) AS c
             FROM lng l JOIN rng r USING (feature) GROUP BY 1, 2, 3)""",
    """tot AS (SELECT feature, count(*) FILTER (WHERE side = 'e') AS n_e, count(*) FILTER (WHERE side = 'a') AS n_a,
             avg(v) FILTER (WHERE side = 'e') AS mean_e, avg(v) FILTER (WHERE side = 'a') AS mean_a,
             stddev_pop(v) FILTER (WHERE side = 'e') AS std_e FROM lng GROUP BY feature)""",
    "grid AS (SELECT feature, lo, hi, unnest(range(0, 10)) AS bin FROM rng)",
    """cells AS (SELECT g.feature, g.lo, g.hi, t.mean_e, t.mean_a, t.std_e,
               (coalesce(ce.c, 0) + 1e-6) / (t.n_e + 1e-6 * 10) AS pe, (coalesce(ca.c, 0) + 1e-6) / (t.n_a + 1e-6 * 10) AS pa
             FROM grid g JOIN tot t USING (feature)
             LEFT JOIN cnt ce ON ce.feature = g.feature AND ce.bin = g.bin AND ce.side = 'e'
             LEFT JOIN cnt ca ON ca.feature = g.feature AND ca.bin = g.bin AND ca.side = 'a')""",
    """rep AS (SELECT feature, CASE WHEN any_value(hi) = any_value(lo) THEN 0.0 ELSE sum((pa - pe) * ln(pa / pe)) END AS psi,
             CASE WHEN any_value(std_e) < 1e-10 THEN abs(any_value(mean_e) - any_value(mean_a))
                  ELSE abs(any_value(mean_e) - any_value(mean_a)) / any_value(std_e) END AS mean_diff
           FROM cells GROUP BY feature)""",
    """st AS (SELECT feature, psi, mean_diff, CASE WHEN psi < 0.1 THEN 'ok' WHEN psi < 0.2 THEN 'slight'
             WHEN psi < 0.25 THEN 'moderate' ELSE 'severe' END AS status FROM rep)"""]

ORACLE["psi_skew"] = with_(_DRIFT, "SELECT feature, round(psi, 6) AS psi, round(mean_diff, 6) AS mean_diff, status FROM st")
ORACLE["drift_summary"] = with_(_DRIFT, """
SELECT status, count(*) AS n_features, string_agg(feature, ',' ORDER BY feature) AS features FROM st GROUP BY status""")

_REQ = ["user_idx", "event_timestamp"] + _UF_COLS
ORACLE["validate_table"] = with_(_KC + _USER_FEAT + [
    f"umap AS (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) AS BIGINT) AS user_idx FROM (SELECT DISTINCT user_id FROM {_CORE}))",
    "t AS (SELECT uf.*, umap.user_idx FROM uf JOIN umap USING (user_id))"],
    " UNION ALL ".join(f"SELECT 'nulls' AS check, '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS value, "
                       f"count(*) FILTER (WHERE {c} IS NULL) = 0 AS passed FROM t" for c in _REQ) +
    """ UNION ALL SELECT 'key_nulls', 'user_idx', count(*) FILTER (WHERE user_idx IS NULL), count(*) FILTER (WHERE user_idx IS NULL) = 0 FROM t
        UNION ALL SELECT 'key_duplicates', 'user_idx', count(*), count(*) = 0 FROM (SELECT user_idx FROM t WHERE user_idx IS NOT NULL GROUP BY user_idx HAVING count(*) > 1)
        UNION ALL SELECT 'extra_column', 'user_id', 1, true
        UNION ALL SELECT 'timestamp_type', 'event_timestamp', 1, true""")

_FRESH = """SELECT '{name}' AS "table", max({ts}) AS latest, round((epoch_us((SELECT max(ts) FROM events)) - epoch_us(max({ts}))) / 86400000000.0, 6) AS age_days,
  CASE WHEN (epoch_us((SELECT max(ts) FROM events)) - epoch_us(max({ts}))) / 86400000000.0 < 1 THEN 'fresh'
       WHEN (epoch_us((SELECT max(ts) FROM events)) - epoch_us(max({ts}))) / 86400000000.0 < 7 THEN 'recent'
       WHEN (epoch_us((SELECT max(ts) FROM events)) - epoch_us(max({ts}))) / 86400000000.0 < 30 THEN 'stale-ish' ELSE 'stale' END AS status,
  (epoch_us((SELECT max(ts) FROM events)) - epoch_us(max({ts}))) / 86400000000.0 < 30 AS passed FROM {src}"""

ORACLE["freshness"] = with_(SNAPS + _USER_FEAT, _FRESH.format(name="snapshots", ts="event_timestamp", src="snaps") +
                            " UNION ALL " + _FRESH.format(name="user_features", ts="event_timestamp", src="uf"))

ORACLE["coverage"] = with_(SNAPS, """
SELECT n_probes, n_present, round(CASE WHEN n_probes > 0 THEN n_present / n_probes ELSE 0.0 END, 6) AS ratio,
       CASE WHEN n_probes > 0 THEN n_present / n_probes ELSE 0.0 END >= 0.6 AS passed
FROM (SELECT count(DISTINCT c_custkey) AS n_probes,
             count(DISTINCT c_custkey) FILTER (WHERE c_custkey IN (SELECT user_id FROM snaps)) AS n_present FROM customer)""")

ORACLE["health_summary"] = with_(SNAPS + [
    "fr AS (SELECT 'freshness:snapshots' AS check, (epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(event_timestamp))) / 86400000000.0 < 30 AS passed FROM snaps)",
    """cv AS (SELECT 'coverage' AS check, (count(DISTINCT c_custkey) FILTER (WHERE c_custkey IN (SELECT user_id FROM snaps)))
             / count(DISTINCT c_custkey) >= 0.6 AS passed FROM customer)""",
    """va AS (SELECT 'validation' AS check, bool_and(ok) AS passed FROM (
             SELECT count(*) FILTER (WHERE user_id IS NULL) = 0 AS ok FROM snaps UNION ALL
             SELECT count(*) FILTER (WHERE event_timestamp IS NULL) = 0 FROM snaps UNION ALL
             SELECT count(*) FILTER (WHERE cum_events IS NULL) = 0 FROM snaps UNION ALL
             SELECT count(*) FILTER (WHERE cum_clicks IS NULL) = 0 FROM snaps UNION ALL
             SELECT count(*) FILTER (WHERE cum_purchases IS NULL) = 0 FROM snaps UNION ALL
             SELECT count(*) FILTER (WHERE cum_value IS NULL) = 0 FROM snaps UNION ALL
             SELECT true))""",
    "al AS (SELECT * FROM fr UNION ALL SELECT * FROM cv UNION ALL SELECT * FROM va)"],
    'SELECT "check", passed FROM al UNION ALL SELECT \'overall\', bool_and(passed) FROM al')

# ---- step 4: retrieval -------------------------------------------------------------------------
VEC = "vx AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
EVI = """evi AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, ts, event_id AS tie
         FROM events WHERE event_type IN ('click', 'purchase', 'view'))"""


def _pool(src: str, name: str = "uv") -> list:
    return [f"""{name}_d AS (SELECT h.user_id, d.i - 1 AS d, avg(d.x) AS m FROM {src} h JOIN vx ON vx.item_id = h.item_id,
                 LATERAL (SELECT unnest(vx.v) AS x, unnest(range(1, len(vx.v) + 1)) AS i) d GROUP BY 1, 2)""",
            f"""{name}_n AS (SELECT user_id, sqrt(sum(m * m)) AS nrm FROM {name}_d GROUP BY user_id)""",
            f"""{name} AS (SELECT d.user_id, list(d.m / greatest(n.nrm, 1e-8) ORDER BY d.d) AS v
                 FROM {name}_d d JOIN {name}_n n USING (user_id) GROUP BY d.user_id)"""]


ORACLE["vector_checks"] = with_([VEC], """
SELECT count(*) AS n_vectors, round(min(nrm), 6) AS norm_min, round(max(nrm), 6) AS norm_max, round(avg(nrm), 6) AS norm_mean,
  CAST(sum(nbad) AS BIGINT) AS n_fixed, round(avg(CASE WHEN nrm2 > 0 THEN nrm2 / greatest(nrm2, 1e-8) ELSE 0 END), 6) AS norm_mean_after
FROM (SELECT sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm,
             len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) AS nbad,
             sqrt(list_sum(list_transform(v, lambda x: CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN 0 ELSE x * x END))) AS nrm2
      FROM vx)""")

ORACLE["vector_topk"] = with_([VEC], """
SELECT qid, CAST(rn AS BIGINT) AS rank, item_id, round(score, 6) AS score FROM (
  SELECT a.item_id AS qid, b.item_id, list_dot_product(a.v, b.v) AS score,
         row_number() OVER (PARTITION BY a.item_id ORDER BY list_dot_product(a.v, b.v) DESC, b.item_id) AS rn
  FROM vx a, vx b) WHERE rn <= 10""")

ORACLE["similar_items"] = with_([VEC], """
SELECT seed_id, CAST(rn AS BIGINT) AS rank, item_id, round(score, 6) AS score FROM (
  SELECT a.item_id AS seed_id, b.item_id, list_dot_product(a.v, b.v) AS score,
         row_number() OVER (PARTITION BY a.item_id ORDER BY list_dot_product(a.v, b.v) DESC, b.item_id) AS rn
  FROM vx a, vx b WHERE a.item_id <> b.item_id) WHERE rn <= 10""")

ORACLE["user_vectors"] = with_([VEC, EVI] + _pool("evi"), """
SELECT user_id, CAST(i - 1 AS BIGINT) AS d, round(x, 6) AS v FROM uv, LATERAL (SELECT unnest(uv.v) AS x, unnest(range(1, len(uv.v) + 1)) AS i)""")

ORACLE["topk_exclude_seen"] = with_([VEC, EVI] + _pool("evi"), """
SELECT user_id, CAST(rn AS BIGINT) AS rank, item_id, round(score, 6) AS score FROM (
  SELECT uv.user_id, vx.item_id, list_dot_product(uv.v, vx.v) AS score,
         row_number() OVER (PARTITION BY uv.user_id ORDER BY list_dot_product(uv.v, vx.v) DESC, vx.item_id) AS rn
  FROM uv, vx WHERE NOT EXISTS (SELECT 1 FROM evi WHERE evi.user_id = uv.user_id AND evi.item_id = vx.item_id)) WHERE rn <= 10""")

ORACLE["recall_at_k"] = with_([VEC, EVI,
    "lr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM evi)",
    "hist AS (SELECT * FROM lr WHERE rn > 1)", "tgt AS (SELECT user_id, item_id AS target_id FROM lr WHERE rn = 1)"] + _pool("hist"), """,
pos AS (SELECT uv.user_id, 1 + count(*) FILTER (WHERE list_dot_product(uv.v, vx.v) > list_dot_product(uv.v, tv.v)
                 OR (list_dot_product(uv.v, vx.v) = list_dot_product(uv.v, tv.v) AND vx.item_id < t.target_id)) AS position
        FROM uv JOIN tgt t USING (user_id) JOIN vx tv ON tv.item_id = t.target_id CROSS JOIN vx GROUP BY uv.user_id)
SELECT CAST(ks.k AS BIGINT) AS k, count(*) AS n_users, round(avg(CASE WHEN position <= ks.k THEN 1.0 ELSE 0.0 END), 6) AS recall
FROM pos, (VALUES (10), (50), (100), (200)) ks(k) GROUP BY ks.k""")

ORACLE["vector_collapse"] = with_([VEC, EVI] + _pool("evi"), """,
s AS (SELECT count(*) AS n FROM uv),
pairs AS (SELECT sum(list_dot_product(a.v, b.v)) AS tot FROM uv a, uv b WHERE a.user_id <> b.user_id)
SELECT n AS n_vectors, round(CASE WHEN n > 1 THEN tot / (n * (n - 1)) END, 6) AS mean_pair_similarity,
       coalesce(CASE WHEN n > 1 THEN tot / (n * (n - 1)) END > 0.9, false) AS collapsed FROM s, pairs""")

ORACLE["pair_scores"] = with_([VEC, EVI] + _pool("evi"), """
SELECT f.event_id, f.user_id, f.item_id, round(list_dot_product(uv.v, vx.v), 6) AS score
FROM (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events
      WHERE event_type IN ('click', 'purchase')) f JOIN uv USING (user_id) JOIN vx USING (item_id)""")

ORACLE["seed_resolution"] = """
SELECT p.p_partkey AS seed_id, coalesce(a.vec_id, b.vec_id, c.vec_id) AS resolved_id FROM part p
LEFT JOIN embeddings a ON a.vec_id = p.p_partkey LEFT JOIN embeddings b ON b.vec_id = p.p_partkey + 1
LEFT JOIN embeddings c ON c.vec_id = p.p_partkey - 1"""

# ---- step 5: ranking set -------------------------------------------------------------------------
_CS = [VEC,
       """ei AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
              CASE WHEN event_type = 'view' THEN 0.0 ELSE 1.0 END AS rating, ts, event_id AS tie
              FROM events WHERE event_type IN ('click', 'purchase', 'view'))""",
       "lr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM ei)",
       "hist AS (SELECT user_id, item_id, rating, ts, tie FROM lr WHERE rn > 1)",
       "tgt AS (SELECT user_id, item_id AS target_id FROM lr WHERE rn = 1)"] + _pool("hist") + [
       """c0 AS (SELECT user_id, CAST(rn AS BIGINT) AS cand_rank, item_id, score FROM (
              SELECT uv.user_id, vx.item_id, list_dot_product(uv.v, vx.v) AS score,
                     row_number() OVER (PARTITION BY uv.user_id ORDER BY list_dot_product(uv.v, vx.v) DESC, vx.item_id) AS rn
              FROM uv, vx WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.user_id = uv.user_id AND h.item_id = vx.item_id))
            WHERE rn <= 100)""",
       "has AS (SELECT DISTINCT c0.user_id FROM c0 JOIN tgt ON c0.user_id = tgt.user_id AND c0.item_id = tgt.target_id)",
       "st AS (SELECT user_id, count(*) AS n, min(score) AS mn, max(cand_rank) AS lst FROM c0 GROUP BY user_id)",
       """miss AS (SELECT t.user_id, t.target_id, st.n, st.mn, st.lst FROM tgt t LEFT JOIN st USING (user_id)
              WHERE t.user_id NOT IN (SELECT user_id FROM has))""",
       """c1 AS (SELECT c0.* FROM c0 WHERE NOT EXISTS (SELECT 1 FROM miss m WHERE m.user_id = c0.user_id AND c0.cand_rank = m.lst)
            UNION ALL SELECT user_id, CAST(coalesce(lst, 1) AS BIGINT), target_id,
                             coalesce(mn - 1e-6, 0.0) FROM miss)""",
       "cs AS (SELECT c1.*, CASE WHEN c1.item_id = t.target_id THEN 1 ELSE 0 END AS label FROM c1 LEFT JOIN tgt t USING (user_id))"]

ORACLE["candidate_set"] = with_(_CS, "SELECT user_id, cand_rank, item_id, round(score, 6) AS score, label FROM cs")

_RF = """rf AS (SELECT cs.*, CASE WHEN n > 1 THEN 1.0 - (cand_rank - 1.0) / (n - 1) ELSE 1.0 END AS rank_norm,
          CASE WHEN hi > lo THEN (score - lo) / (hi - lo) ELSE 0.5 END AS score_norm,
          coalesce(lag(score) OVER (PARTITION BY user_id ORDER BY cand_rank) - score, 0.0) AS score_gap,
          CAST(cand_rank AS DOUBLE) / n AS rank_norm_serve,
          first_value(score) OVER (PARTITION BY user_id ORDER BY cand_rank) - score AS score_gap_top,
          CASE WHEN hi > lo THEN (score - lo) / (hi - lo) ELSE 0.0 END AS score_norm_serve
        FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, min(score) OVER (PARTITION BY user_id) AS lo,
                     max(score) OVER (PARTITION BY user_id) AS hi FROM cs) cs)"""

ORACLE["retrieval_features"] = with_(_CS + [_RF], """
SELECT user_id, cand_rank, item_id, round(score, 6) AS score, label, round(rank_norm, 6) AS rank_norm,
  round(score_norm, 6) AS score_norm, round(score_gap, 6) AS score_gap, round(rank_norm_serve, 6) AS rank_norm_serve,
  round(score_gap_top, 6) AS score_gap_top, round(score_norm_serve, 6) AS score_norm_serve FROM rf""")

_GEN = [f"it AS ({ITEMS})",
        "gv AS (SELECT DISTINCT unnest(string_split(genres, '|')) AS genre FROM it)",
        "oh AS (SELECT it.item_id, gv.genre FROM it JOIN gv ON contains(it.genres, gv.genre) WHERE gv.genre <> '(no genres listed)')",
        "pc AS (SELECT h.user_id, oh.genre, count(*) AS c FROM hist h JOIN oh USING (item_id) GROUP BY 1, 2)",
        "pref AS (SELECT user_id, genre, c / sum(c) OVER (PARTITION BY user_id) AS pref FROM pc)",
        "pairs AS (SELECT DISTINCT user_id, item_id FROM cs)",
        """go AS (SELECT p.user_id, p.item_id, sum(coalesce(pref.pref, 0.0)) AS genre_overlap, max(coalesce(pref.pref, 0.0)) AS genre_max_match
               FROM pairs p JOIN oh USING (item_id) LEFT JOIN pref ON pref.user_id = p.user_id AND pref.genre = oh.genre GROUP BY 1, 2)"""]

ORACLE["genre_overlap"] = with_(_CS + _GEN + [
    f"v AS ({VOCAB})",
    f"ig AS (SELECT x.item_id, x.genre, v.idx, x.pos FROM ({IG}) x JOIN v ON v.genre = x.genre)",
    "rec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS r FROM hist) WHERE r <= 50)",
    "prof AS (SELECT rec.user_id, ig.genre, count(*) AS c FROM rec JOIN ig USING (item_id) GROUP BY 1, 2)",
    "share AS (SELECT user_id, genre, c / sum(c) OVER (PARTITION BY user_id) AS s FROM prof)",
    "topg AS (SELECT user_id, genre AS top_genre FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, genre) AS r FROM prof) WHERE r = 1)",
    "ng AS (SELECT item_id, count(*) AS ng FROM ig GROUP BY item_id)",
    """ov AS (SELECT p.user_id, p.item_id, sum(coalesce(share.s, 0.0)) AS sm FROM pairs p JOIN ig USING (item_id)
            LEFT JOIN share ON share.user_id = p.user_id AND share.genre = ig.genre GROUP BY 1, 2)""",
    """same AS (SELECT p.user_id, p.item_id, max(CASE WHEN ig.genre = topg.top_genre THEN 1 ELSE 0 END) AS sm
              FROM pairs p JOIN topg USING (user_id) LEFT JOIN ig USING (item_id) GROUP BY 1, 2)""",
    "prim AS (SELECT item_id, arg_min(idx, pos) AS pg FROM ig GROUP BY item_id)",
    "per AS (SELECT h.user_id, prim.pg, count(*) AS c FROM hist h JOIN prim USING (item_id) GROUP BY 1, 2)",
    "tot AS (SELECT user_id, count(*) AS t FROM hist GROUP BY user_id)"], """
SELECT cs.user_id, cs.cand_rank, cs.item_id, round(coalesce(go.genre_overlap, 0.0), 6) AS genre_overlap,
  round(coalesce(go.genre_max_match, 0.0), 6) AS genre_max_match,
  round(CASE WHEN ng.ng > 0 THEN coalesce(ov.sm, 0.0) / ng.ng ELSE 0.0 END, 6) AS online_overlap,
  CAST(coalesce(same.sm, 0) AS BIGINT) AS is_same_top_genre,
  round(CASE WHEN tot.t > 0 THEN coalesce(per.c, 0) / tot.t ELSE 0.0 END, 6) AS primary_genre_overlap
FROM cs LEFT JOIN go USING (user_id, item_id) LEFT JOIN ov USING (user_id, item_id) LEFT JOIN ng USING (item_id)
LEFT JOIN same USING (user_id, item_id) LEFT JOIN prim USING (item_id)
LEFT JOIN per ON per.user_id = cs.user_id AND per.pg = prim.pg LEFT JOIN tot ON tot.user_id = cs.user_id""")

_RM_USER = ["user_rating_count", "user_avg_rating", "user_min_rating", "user_max_rating", "user_rating_std",
            "user_active_days", "user_days_since_last", "user_sequence_length"]
_RM_ITEM = ["item_rating_count", "item_avg_rating", "item_rating_std", "item_popularity", "item_log_popularity",
            "item_days_since_last_rating", "item_active_days", "item_year", "item_num_genres", "item_popularity_rank"]
_RM_LIST = ["score", "cand_rank", "rank_norm", "score_norm", "score_gap"]
_RM_PAIR = ["genre_overlap", "genre_max_match", "item_popularity_pct"]
_RM_GENRE = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"] + [f"Brand#{i}" for i in range(1, 14)]
_RM_FEATS = _RM_USER + _RM_ITEM + [f'"genre_{g}"' for g in _RM_GENRE] + _RM_LIST + _RM_PAIR

_RM = _CS + [_RF] + _GEN + [
    "hnow AS (SELECT max(ts) AS now FROM hist)",
    f"""ruf AS (SELECT user_id, count(*) AS user_rating_count, avg(rating) AS user_avg_rating,
            min(rating) AS user_min_rating, max(rating) AS user_max_rating,
            coalesce(stddev_samp(rating), 0.0) AS user_rating_std, {_days('max(ts)', 'min(ts)')} AS user_active_days,
            {_days('any_value(hnow.now)', 'max(ts)')} AS user_days_since_last, count(*) AS user_sequence_length
          FROM hist CROSS JOIN hnow GROUP BY user_id)""",
    f"""ri0 AS (SELECT item_id, count(*) AS item_rating_count, avg(rating) AS item_avg_rating,
            coalesce(stddev_samp(rating), 0.0) AS item_rating_std, count(*) AS item_popularity, ln(1 + count(*)) AS item_log_popularity,
            {_days('any_value(hnow.now)', 'max(ts)')} AS item_days_since_last_rating, {_days('max(ts)', 'min(ts)')} AS item_active_days
          FROM hist CROSS JOIN hnow GROUP BY item_id)""",
    """rif AS (SELECT ri0.*, coalesce(CAST(nullif(regexp_extract(it.title, '\\((\\d{4})\\)', 1), '') AS INTEGER), 0) AS item_year,
            (SELECT count(*) FROM oh WHERE oh.item_id = ri0.item_id) AS item_num_genres,
            dense_rank() OVER (ORDER BY ri0.item_rating_count DESC) AS item_popularity_rank
          FROM ri0 LEFT JOIN it USING (item_id))""",
    "mx AS (SELECT max(item_rating_count) AS m FROM rif)",
    """rm AS (SELECT rf.user_id, rf.item_id, rf.label, """ +
    ", ".join(f"coalesce(CAST(ruf.{c} AS DOUBLE), 0.0) AS {c}" for c in _RM_USER) + ", " +
    ", ".join(f"coalesce(CAST(rif.{c} AS DOUBLE), 0.0) AS {c}" for c in _RM_ITEM) + ", " +
    ", ".join(f"""CAST(rf.item_id IN (SELECT item_id FROM it WHERE contains(genres, '{g}')) AND rif.item_id IS NOT NULL AS DOUBLE)
              AS "genre_{g}\"""" for g in _RM_GENRE) + ", " +
    ", ".join(f"CAST(rf.{c} AS DOUBLE) AS {c}" for c in _RM_LIST) + """,
            coalesce(go.genre_overlap, 0.0) AS genre_overlap, coalesce(go.genre_max_match, 0.0) AS genre_max_match,
            CASE WHEN mx.m > 0 THEN coalesce(rif.item_rating_count, 0) / mx.m ELSE 0.0 END AS item_popularity_pct
          FROM rf LEFT JOIN go USING (user_id, item_id) LEFT JOIN ruf USING (user_id) LEFT JOIN rif USING (item_id) CROSS JOIN mx)"""]

ORACLE["ranking_matrix"] = with_(_RM, "SELECT user_id, item_id, label, " +
                                 ", ".join(f"round({c}, 6) AS {c}" for c in _RM_FEATS) + " FROM rm")

ORACLE["ranking_stats"] = with_(_RM, f"""
SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, CAST({len(_RM_FEATS)} AS BIGINT) AS n_features,
  round(avg(CAST(label AS DOUBLE)), 6) AS positive_rate,
  round((SELECT avg(CAST(h AS DOUBLE)) FROM (SELECT max(label) AS h FROM rm GROUP BY user_id)), 6) AS hit_rate,
  count(*) FILTER (WHERE label NOT IN (0, 1) OR label IS NULL) AS bad_labels,
  count(*) FILTER (WHERE label NOT IN (0, 1) OR label IS NULL) = 0 AS valid FROM rm""")


def _group_metrics(src: str, s: str, ks=(5, 10)) -> list:
    cols = []
    for k in ks:
        cols += [f"sum(CASE WHEN rs <= {k} THEN (pow(2.0, rel) - 1.0) / log2(rs + 1.0) ELSE 0.0 END) AS dcg{k}",
                 f"sum(CASE WHEN ri <= {k} THEN (pow(2.0, rel) - 1.0) / log2(ri + 1.0) ELSE 0.0 END) AS idcg{k}",
                 f"max(CASE WHEN rs <= {k} AND rel > 0 THEN 1.0 ELSE 0.0 END) AS hr{k}",
                 f"max(CASE WHEN rs <= {k} AND rel > 0 THEN 1.0 / rs ELSE 0.0 END) AS mrr{k}"]
    outs = ["count(*) AS n_groups"]
    for k in ks:
        outs += [f"avg(CASE WHEN idcg{k} > 0 THEN dcg{k} / idcg{k} ELSE 0.0 END) AS ndcg_{k}", f"avg(hr{k}) AS hr_{k}",
                 f"avg(mrr{k}) AS mrr_{k}"]
    return [f"""gx AS (SELECT user_id, CAST(label AS DOUBLE) AS rel,
                 row_number() OVER (PARTITION BY user_id ORDER BY {s} DESC, item_id) AS rs,
                 row_number() OVER (PARTITION BY user_id ORDER BY label DESC, {s} DESC, item_id) AS ri FROM {src})""",
            "gp AS (SELECT user_id, " + ", ".join(cols) + " FROM gx GROUP BY user_id)",
            "gm AS (SELECT " + ", ".join(outs) + " FROM gp)"]


def _gm_renamed(prefix: str, src: str, s: str) -> list:
    return [c.replace("gx AS", f"{prefix}x AS").replace("FROM gx", f"FROM {prefix}x").replace("gp AS", f"{prefix}p AS")
            .replace("FROM gp", f"FROM {prefix}p").replace("gm AS", f"{prefix}m AS") for c in _group_metrics(src, s)]


ORACLE["group_ndcg"] = with_(_CS + [_RF] + _group_metrics("rf", "rank_norm"), """
SELECT n_groups, round(ndcg_5, 6) AS ndcg_5, round(hr_5, 6) AS hr_5, round(mrr_5, 6) AS mrr_5,
  round(ndcg_10, 6) AS ndcg_10, round(hr_10, 6) AS hr_10, round(mrr_10, 6) AS mrr_10 FROM gm""")

_LONG = "SELECT metric, value FROM (UNPIVOT (SELECT ndcg_5, hr_5, mrr_5, ndcg_10, hr_10, mrr_10 FROM {m}) ON ndcg_5, hr_5, mrr_5, ndcg_10, hr_10, mrr_10 INTO NAME metric VALUE value)"
ORACLE["metric_comparison"] = with_(_RM + _gm_renamed("a", "rm", "rank_norm") + _gm_renamed("b", "rm", "item_popularity_pct") + [
    f"la AS ({_LONG.format(m='am')})", f"lb AS ({_LONG.format(m='bm')})"], """
SELECT coalesce(la.metric, lb.metric) AS metric, round(la.value, 6) AS a, round(lb.value, 6) AS b,
  round(lb.value - la.value, 6) AS delta,
  round(CASE WHEN la.value <> 0 THEN (lb.value - la.value) / la.value * 100.0 ELSE 0.0 END, 6) AS pct_change,
  CASE WHEN lb.value - la.value > 0.005 THEN '++' WHEN lb.value - la.value > 0 THEN '+' ELSE '-' END AS marker
FROM la FULL JOIN lb USING (metric)""")

ORACLE["list_overlap"] = with_(_RM + [
    "ta AS (SELECT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS r FROM rm) WHERE r <= 10)",
    "tb AS (SELECT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_popularity_pct DESC, item_id) AS r FROM rm) WHERE r <= 10)",
    "cm AS (SELECT user_id, count(*) AS o FROM ta JOIN tb USING (user_id, item_id) GROUP BY user_id)",
    "us AS (SELECT user_id FROM ta UNION SELECT user_id FROM tb)"], """
SELECT us.user_id, CAST(coalesce(cm.o, 0) AS BIGINT) AS overlap, round(coalesce(cm.o, 0) / 10.0, 6) AS overlap_ratio
FROM us LEFT JOIN cm USING (user_id)""")

ORACLE["top_k_ranked"] = with_(_RM + [
    "sc AS (SELECT user_id, item_id, 1.0 / (1.0 + exp(-(score + genre_overlap))) AS final_score FROM rm "
    "WHERE NOT EXISTS (SELECT 1 FROM ei WHERE ei.user_id = rm.user_id AND ei.item_id = rm.item_id))",
    "tk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY final_score DESC, item_id) AS r FROM sc)"], """
SELECT tk.user_id, CAST(tk.r AS BIGINT) AS rank, tk.item_id, round(tk.final_score, 6) AS final_score,
  coalesce(it.title, 'Unknown') AS title FROM tk LEFT JOIN it USING (item_id) WHERE tk.r <= 10""")

# ---- step 7: experiments and bandits ------------------------------------------------------------------
CFG = """cfg AS (SELECT * FROM (VALUES ('retrieval_v1', ['mf', 'sasrec'], [0.5, 0.5], true),
                                   ('ranking_blend_v1', ['lgbm_only', 'lgbm_bandit'], [0.5, 0.5], true))
                 t(experiment_id, variants, traffic_split, is_active))"""


def assign_expr(user: str, exp: str) -> str:
    bucket = f"((('0x' || substr(md5(CAST({user} AS VARCHAR) || ':' || {exp}), 1, 8))::BIGINT % 10000) / 10000.0)"
    cum = "list_transform(range(1, len(cfg.traffic_split) + 1), lambda i: list_sum(cfg.traffic_split[1:i]))"
    idx = f"coalesce(list_position(list_transform({cum}, lambda b: {bucket} < b), true), 0)"
    return (f"CASE WHEN NOT cfg.is_active THEN cfg.variants[1] WHEN {idx} > 0 THEN cfg.variants[{idx}] "
            f"ELSE cfg.variants[-1] END")


_ASSIGN = [CFG, """req AS (SELECT c_custkey AS user_id, 'retrieval_v1' AS experiment_id FROM customer
                          UNION ALL SELECT c_custkey, 'ranking_blend_v1' FROM customer)""",
           f"asg AS (SELECT req.user_id, req.experiment_id, {assign_expr('req.user_id', 'req.experiment_id')} AS variant FROM req JOIN cfg USING (experiment_id))"]

ORACLE["ab_assign"] = with_(_ASSIGN, "SELECT * FROM asg")
ORACLE["ab_distribution"] = with_(_ASSIGN, "SELECT experiment_id, variant, count(*) AS n_users FROM asg GROUP BY 1, 2")
ORACLE["ab_config_check"] = with_([CFG], """
SELECT experiment_id, len(variants) = len(traffic_split) AS lengths_match, abs(list_sum(traffic_split) - 1.0) < 1e-6 AS sums_to_one,
  list_bool_and(list_transform(traffic_split, lambda x: x > 0)) AS all_positive,
  len(variants) = len(traffic_split) AND abs(list_sum(traffic_split) - 1.0) < 1e-6 AND list_bool_and(list_transform(traffic_split, lambda x: x > 0)) AS valid,
  CAST(coalesce((SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'view' AND cfg.experiment_id = 'retrieval_v1'), 0) AS BIGINT) AS exposed_users
FROM cfg""")

_STATS = [CFG,
          f"""ex AS (SELECT e.event_id, e.user_id, 'retrieval_v1' AS experiment_id, e.ts, {assign_expr('e.user_id', "'retrieval_v1'")} AS variant
                 FROM events e JOIN cfg ON cfg.experiment_id = 'retrieval_v1' WHERE e.event_type = 'view')""",
          "cv AS (SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS variant, 'retrieval_v1' AS experiment_id, ts FROM events WHERE event_type = 'click')",
          """lastv AS (SELECT user_id, experiment_id, variant FROM (SELECT *, row_number() OVER (PARTITION BY user_id, experiment_id
                  ORDER BY ts DESC, event_id DESC) AS r FROM ex) WHERE r = 1)""",
          "ca AS (SELECT cv.experiment_id, coalesce(cv.variant, lastv.variant, 'unknown') AS variant FROM cv LEFT JOIN lastv USING (user_id, experiment_id))",
          "e AS (SELECT experiment_id, variant, count(*) AS exposures FROM ex GROUP BY 1, 2)",
          "c AS (SELECT experiment_id, variant, count(*) AS conversions FROM ca GROUP BY 1, 2)",
          """j AS (SELECT experiment_id, variant, coalesce(exposures, 0) AS exposures, coalesce(conversions, 0) AS conversions
                FROM e FULL JOIN c USING (experiment_id, variant))""",
          """vs0 AS (SELECT *, CASE WHEN exposures > 0 THEN least(conversions, exposures) ELSE 0 END AS effective_conversions,
                  CASE WHEN exposures > 0 THEN least(conversions, exposures) / exposures ELSE 0.0 END AS ctr FROM j)""",
          """vs1 AS (SELECT *, CASE WHEN exposures > 0 THEN sqrt(greatest(0.0, least(1.0, ctr)) * (1 - greatest(0.0, least(1.0, ctr))) / exposures) ELSE 0.0 END AS std_err FROM vs0)""",
          "vs AS (SELECT *, greatest(0.0, ctr - 1.96 * std_err) AS ci_low, least(1.0, ctr + 1.96 * std_err) AS ci_high FROM vs1)"]

ORACLE["ab_variant_stats"] = with_(_STATS, """
SELECT experiment_id, variant, exposures, conversions, CAST(effective_conversions AS BIGINT) AS effective_conversions,
  round(ctr, 6) AS ctr, round(std_err, 6) AS std_err, round(ci_low, 6) AS ci_low, round(ci_high, 6) AS ci_high FROM vs""")


def _p_sql(z: str) -> str:
    """2 phi(|z|) * integral of exp(-|z| t - t^2 / 2) over t >= 0, by Simpson's rule."""
    return (f"(SELECT 2 * exp(-{z} * {z} / 2) / sqrt(2 * pi()) * 0.0005 / 3 * sum("
            f"CASE WHEN i IN (0, 24000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
            f" * exp(-abs({z}) * i * 0.0005 - i * i * 0.000000125)) FROM range(24001) g(i))")


_ZT = _STATS + [
    """zj AS (SELECT cfg.experiment_id, cfg.variants[1] AS control, cfg.variants[2] AS treatment,
              coalesce(a.exposures, 0) AS n_a, coalesce(a.effective_conversions, 0) AS k_a,
              coalesce(b.exposures, 0) AS n_b, coalesce(b.effective_conversions, 0) AS k_b,
              coalesce(a.ctr, 0.0) AS ctr_a, coalesce(b.ctr, 0.0) AS ctr_b
            FROM cfg LEFT JOIN vs a ON a.experiment_id = cfg.experiment_id AND a.variant = cfg.variants[1]
                     LEFT JOIN vs b ON b.experiment_id = cfg.experiment_id AND b.variant = cfg.variants[2])""",
    """zs AS (SELECT *, sqrt(greatest(0.0, least(1.0, (k_a + k_b) / (n_a + n_b))) * (1 - greatest(0.0, least(1.0, (k_a + k_b) / (n_a + n_b))))
                 * (1.0 / n_a + 1.0 / n_b)) AS se, n_a > 0 AND n_b > 0 AS ok FROM zj WHERE n_a + n_b > 0)""",
    "zz AS (SELECT *, CASE WHEN ok AND se >= 1e-10 THEN (ctr_b - ctr_a) / se ELSE 0.0 END AS z FROM zs)",
    f"""zp AS (SELECT *, CASE WHEN ok AND se >= 1e-10 THEN {_p_sql('z')} ELSE 1.0 END AS p_value,
              CASE WHEN ctr_a > 0 THEN (ctr_b - ctr_a) / ctr_a * 100.0 ELSE 0.0 END AS rel FROM zz)""",
    """zt AS (SELECT experiment_id, control, treatment, n_a, k_a, n_b, k_b, ctr_a, ctr_b, z, p_value, rel AS relative_lift_pct,
              ctr_b - ctr_a AS absolute_lift, p_value < 0.050000000000000044 AS is_significant,
              least(ctr_a + 0.05, 0.999999) AS p2 FROM zp)"""]

ORACLE["ab_ztest"] = with_(_ZT, """
SELECT experiment_id, control, treatment, n_a, CAST(k_a AS BIGINT) AS k_a, n_b, CAST(k_b AS BIGINT) AS k_b, round(ctr_a, 6) AS ctr_a,
  round(ctr_b, 6) AS ctr_b, round(z, 6) AS z, round(p_value, 6) AS p_value, round(relative_lift_pct, 6) AS relative_lift_pct,
  round(absolute_lift, 6) AS absolute_lift, is_significant,
  CASE WHEN p_value = 0.0 THEN '<1e-16' WHEN p_value < 1e-4 THEN printf('%.2e', p_value) ELSE printf('%.4f', p_value) END AS p_value_text,
  CASE WHEN NOT is_significant THEN 'collect_more_data' WHEN relative_lift_pct > 0 THEN 'deploy_treatment' ELSE 'keep_control' END AS decision,
  round(CASE WHEN pow(p2 - ctr_a, 2) > 0 THEN pow(1.959963984540054 * sqrt(2 * ((ctr_a + p2) / 2) * (1 - (ctr_a + p2) / 2))
        + 0.8416212335729143 * sqrt(ctr_a * (1 - ctr_a) + p2 * (1 - p2)), 2) / pow(p2 - ctr_a, 2) ELSE 'inf'::DOUBLE END, 6) AS min_sample_size
FROM zt""")

ORACLE["ab_report"] = with_(_ZT + [
    """rv AS (SELECT cfg.experiment_id, CAST(v.i - 1 AS INTEGER) AS variant_order, v.variant FROM cfg,
             LATERAL (SELECT unnest(cfg.variants) AS variant, unnest(range(1, len(cfg.variants) + 1)) AS i) v)""",
    """rr AS (SELECT rv.experiment_id, rv.variant, rv.variant_order, coalesce(vs.exposures, 0) AS exposures,
              coalesce(vs.conversions, 0) AS conversions, coalesce(vs.ci_low, 0.0) AS ci_low, coalesce(vs.ci_high, 0.0) AS ci_high,
              CASE WHEN coalesce(vs.exposures, 0) > 0 THEN vs.conversions / vs.exposures ELSE 0.0 END AS ctr
            FROM rv LEFT JOIN vs USING (experiment_id, variant))""",
    """best AS (SELECT experiment_id, variant AS best FROM (SELECT *, row_number() OVER (PARTITION BY experiment_id
              ORDER BY ctr DESC, variant_order) AS r FROM rr) WHERE r = 1)""",
    """win AS (SELECT b.experiment_id, coalesce(zt.z, 0.0) AS z, coalesce(zt.p_value, 1.0) AS p_value,
              coalesce(zt.is_significant, false) AS is_significant,
              CASE WHEN zt.is_significant THEN CASE WHEN zt.relative_lift_pct > 0 THEN zt.treatment ELSE zt.control END ELSE b.best END AS winner
            FROM best b LEFT JOIN zt USING (experiment_id))"""], """
SELECT rr.experiment_id, rr.variant, rr.variant_order, rr.exposures, rr.conversions, round(rr.ci_low, 6) AS ci_low,
  round(rr.ci_high, 6) AS ci_high, round(rr.ctr, 6) AS ctr, round(win.z, 6) AS z, round(win.p_value, 6) AS p_value,
  win.is_significant, win.winner FROM rr LEFT JOIN win USING (experiment_id)""")

ORACLE["ab_totals"] = """
SELECT 'exposures' AS kind, count(*) AS n FROM events WHERE event_type = 'view'
UNION ALL SELECT 'conversions', count(*) FROM events WHERE event_type = 'click'"""

ORACLE["ab_session_conversion"] = with_([CFG,
    "ev AS (SELECT event_id, user_id, ts, event_type = 'view' AS is_exposure, event_type = 'click' AS is_conversion FROM events WHERE event_type IN ('view', 'click'))",
    """sg AS (SELECT *, sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 3600000000 THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
            FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM ev))""",
    "ss AS (SELECT user_id, sid, max(CAST(is_conversion AS INTEGER)) AS converted, max(CAST(is_exposure AS INTEGER)) AS e FROM sg GROUP BY 1, 2)",
    f"sv AS (SELECT ss.*, {assign_expr('ss.user_id', "'retrieval_v1'")} AS variant FROM ss JOIN cfg ON cfg.experiment_id = 'retrieval_v1' WHERE e = 1)"],
    """SELECT variant, count(*) AS sessions, CAST(sum(converted) AS BIGINT) AS converted, round(avg(CAST(converted AS DOUBLE)), 6) AS session_ctr
       FROM sv GROUP BY variant""")

FB = """fb AS (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
          CASE WHEN event_type = 'view' THEN 0.0 ELSE 1.0 END AS reward, ts FROM events WHERE event_type IN ('click', 'purchase', 'view'))"""
FB_CUT = "fcut AS (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 AS c FROM fb)"
POST = "post AS (SELECT item_id, 1.0 + sum(reward) AS alpha, 1.0 + sum(1.0 - reward) AS beta FROM {src} GROUP BY item_id)"
ARM = """arm AS (SELECT *, CAST(alpha + beta - 2 AS BIGINT) AS trials, alpha / (alpha + beta) AS expected_ctr,
           alpha * beta / (pow(alpha + beta, 2) * (alpha + beta + 1)) AS variance FROM post)"""

ORACLE["bandit_posterior"] = with_([FB, POST.format(src="fb"), ARM], """
SELECT item_id, round(alpha, 6) AS alpha, round(beta, 6) AS beta, trials, round(expected_ctr, 6) AS expected_ctr,
  round(variance, 6) AS variance FROM arm""")

ORACLE["bandit_merge"] = with_([FB, FB_CUT,
    "h1 AS (SELECT fb.* FROM fb, fcut WHERE epoch_us(ts) < fcut.c)", "h2 AS (SELECT fb.* FROM fb, fcut WHERE epoch_us(ts) >= fcut.c)",
    POST.format(src="h1"), "inc AS (SELECT item_id, sum(reward) AS s, sum(1.0 - reward) AS f FROM h2 GROUP BY item_id)"], """
SELECT item_id, round(coalesce(post.alpha, 1.0) + coalesce(inc.s, 0.0), 6) AS alpha,
  round(coalesce(post.beta, 1.0) + coalesce(inc.f, 0.0), 6) AS beta FROM post FULL JOIN inc USING (item_id)""")

ORACLE["bandit_stats"] = with_([FB, POST.format(src="fb"), ARM], """
SELECT count(*) AS n_arms, CAST(sum(trials) AS BIGINT) AS total_trials, round(avg(trials), 6) AS avg_trials, max(trials) AS max_trials,
  round(avg(expected_ctr), 6) AS avg_ctr, round(max(expected_ctr), 6) AS max_ctr, round(min(expected_ctr), 6) AS min_ctr,
  count(*) FILTER (WHERE trials >= 10) AS arms_10_plus, round(count(*) / (SELECT count(*) FROM part) * 100.0, 6) AS coverage_pct FROM arm""")

ORACLE["bandit_top"] = with_([FB, POST.format(src="fb"), ARM], """
SELECT item_id, round(alpha, 6) AS alpha, round(beta, 6) AS beta, trials, round(expected_ctr, 6) AS expected_ctr,
  round(variance, 6) AS variance, CAST(r AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY expected_ctr DESC, item_id) AS r FROM arm) WHERE r <= 20""")

ORACLE["bandit_parse"] = with_([FB, POST.format(src="fb")], "SELECT item_id, alpha, beta, false AS corrupt FROM post")

ORACLE["bandit_learning"] = with_([FB, FB_CUT, "h1 AS (SELECT fb.* FROM fb, fcut WHERE epoch_us(ts) < fcut.c)",
                                   POST.format(src="h1"), ARM,
                                   "truth AS (SELECT item_id, avg(reward) AS true_ctr FROM fb GROUP BY item_id)"], """
SELECT item_id, round(expected_ctr, 6) AS expected_ctr, round(true_ctr, 6) AS true_ctr,
  round(abs(expected_ctr - true_ctr), 6) AS abs_error, abs(expected_ctr - true_ctr) < 0.1 AS learned
FROM arm JOIN truth USING (item_id)""")

# ---- step 8: monitoring and governance ------------------------------------------------------------------
REQ = """req AS (SELECT ts, 'GET' AS method, event_type AS path, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
           value AS latency_ms, CAST(json_extract_string(props, '$.k') AS BIGINT) < 50 AS cached, user_id FROM events)"""

ORACLE["latency_sla"] = with_([REQ, "span AS (SELECT (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6 AS s FROM req)",
    """g AS (SELECT CASE WHEN grouping(path) = 1 THEN 'Aggregated' ELSE path END AS path, count(*) AS n,
             count(*) FILTER (WHERE status >= 500) AS errors, quantile_disc(latency_ms, 0.5) AS p50_ms,
             quantile_disc(latency_ms, 0.95) AS p95_ms, quantile_disc(latency_ms, 0.99) AS p99_ms, avg(latency_ms) AS avg_ms
           FROM req GROUP BY ROLLUP (path))"""], """
SELECT path, n, errors, round(errors / n * 100.0, 6) AS error_pct, round(p50_ms, 6) AS p50_ms, round(p95_ms, 6) AS p95_ms,
  round(p99_ms, 6) AS p99_ms, round(avg_ms, 6) AS avg_ms, round(CASE WHEN span.s > 0 THEN n / span.s ELSE 0.0 END, 6) AS rps,
  p95_ms <= 200.0 AS p95_ok, errors / n * 100.0 <= 1.0 AS errors_ok, CASE WHEN span.s > 0 THEN n / span.s ELSE 0.0 END >= 50.0 AS rps_ok
FROM g, span""")

ORACLE["stage_breakdown"] = with_([REQ, "m AS (SELECT path, avg(latency_ms) AS mean_ms FROM req GROUP BY path)"], """
SELECT path, round(mean_ms, 6) AS mean_ms, round(mean_ms / (SELECT sum(mean_ms) FROM m) * 100.0, 6) AS pct_of_total,
  round(CASE WHEN mean_ms > 0 THEN 1000.0 / mean_ms END, 6) AS throughput_per_s FROM m""")

ORACLE["request_counters"] = with_([REQ, CFG,
    f"rv AS (SELECT req.*, {assign_expr('req.user_id', "'retrieval_v1'")} AS variant FROM req JOIN cfg ON cfg.experiment_id = 'retrieval_v1')"], """
SELECT variant, CASE WHEN status >= 500 THEN 'error' WHEN cached THEN 'cache_hit' ELSE 'success' END AS outcome, count(*) AS n
FROM rv GROUP BY 1, 2""")

ORACLE["cache_hit_cumulative"] = with_([REQ, """b AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket_start, count(*) AS requests,
    count(*) FILTER (WHERE cached) AS hits FROM req GROUP BY 1)"""], """
SELECT bucket_start, requests, hits, CAST(sum(requests) OVER w AS BIGINT) AS cum_requests, CAST(sum(hits) OVER w AS BIGINT) AS cum_hits,
  round(sum(hits) OVER w / sum(requests) OVER w, 6) AS cum_hit_ratio
FROM b WINDOW w AS (ORDER BY bucket_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

_LES = [0.005, 0.01, 0.025, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0]


def _hq(q: float) -> str:
    les = "[" + ", ".join(repr(x) for x in _LES) + "]"
    rank = f"({q} * n)"
    idx = f"coalesce(list_position(list_transform(cums, lambda c: c >= {rank}), true), 0)"
    upper = f"{les}[{idx}]"
    lower = f"(CASE WHEN {idx} > 1 THEN {les}[{idx} - 1] ELSE 0.0 END)"
    chi = f"cums[{idx}]"
    clo = f"(CASE WHEN {idx} > 1 THEN cums[{idx} - 1] ELSE 0 END)"
    inside = f"(CASE WHEN {chi} > {clo} THEN {lower} + ({upper} - {lower}) * ({rank} - {clo}) / ({chi} - {clo}) ELSE {upper} END)"
    return f"round(CASE WHEN n = 0 THEN NULL WHEN {idx} = 0 THEN {_LES[-1]} ELSE {inside} END, 6)"


ORACLE["latency_histogram_quantile"] = with_([REQ, "g AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS n, [" +
    ", ".join(f"count(*) FILTER (WHERE latency_ms / 1000.0 <= {le})" for le in _LES) + "] AS cums FROM req GROUP BY 1)"],
    f"SELECT window_start, n, {_hq(0.5)} AS q50, {_hq(0.95)} AS q95, {_hq(0.99)} AS q99 FROM g")

ORACLE["request_rate"] = with_([REQ], """
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, count(*) AS n, round(count(*) / 300.0, 6) AS rps FROM (
  SELECT time_bucket(INTERVAL 1 MINUTE, ts) - k * INTERVAL 1 MINUTE AS ws FROM req, (SELECT unnest(range(0, 5)) AS k)) GROUP BY ws""")

_ALERT = [REQ, """g AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS n, count(*) FILTER (WHERE status >= 500) AS errors,
             count(*) FILTER (WHERE cached) AS hits FROM req GROUP BY 1)""",
          "grid AS (SELECT unnest(generate_series((SELECT min(window_start) FROM g), (SELECT max(window_start) FROM g), INTERVAL 5 MINUTE)) AS window_start)",
          """aw AS (SELECT grid.window_start, coalesce(n, 0) AS n,
               CASE WHEN coalesce(n, 0) > 0 THEN errors / n ELSE 0.0 END AS error_rate,
               CASE WHEN coalesce(n, 0) > 0 THEN hits / n ELSE 0.0 END AS hit_ratio FROM grid LEFT JOIN g USING (window_start))""",
          """al AS (SELECT window_start, n, error_rate, hit_ratio, error_rate > 0.05 AS high_error, n = 0 AS no_traffic,
               n > 0 AND hit_ratio < 0.2 AS low_cache FROM aw)"""]

ORACLE["alert_windows"] = with_(_ALERT, "SELECT window_start, n, round(error_rate, 6) AS error_rate, round(hit_ratio, 6) AS hit_ratio, high_error, no_traffic, low_cache FROM al")


def _islands(flag: str, min_w: int) -> str:
    return f"""SELECT '{flag}' AS alert, min(window_start) AS start, max(window_start) AS "end", count(*) AS n_windows, count(*) >= {min_w} AS fired
FROM (SELECT window_start, {flag}, row_number() OVER (ORDER BY window_start) - row_number() OVER (PARTITION BY {flag} ORDER BY window_start) AS isl FROM al)
WHERE {flag} GROUP BY isl"""


ORACLE["alert_islands"] = with_(_ALERT, _islands("high_error", 2) + " UNION ALL " + _islands("low_cache", 2) + " UNION ALL " + _islands("no_traffic", 1))

ORACLE["feedback_polarity"] = with_([FB, CFG,
    f"fv AS (SELECT fb.*, {assign_expr('fb.user_id', "'retrieval_v1'")} AS variant FROM fb JOIN cfg ON cfg.experiment_id = 'retrieval_v1')"], """
SELECT variant, count(*) FILTER (WHERE reward <= 0) AS negative, count(*) FILTER (WHERE reward > 0) AS positive FROM fv GROUP BY variant""")

_SERVED = _CS + [CFG, f"v AS ({VOCAB})", f"it AS ({ITEMS})",
                 f"ig AS (SELECT x.item_id, x.genre, v.idx, x.pos FROM ({IG}) x JOIN v ON v.genre = x.genre)",
                 f"sl AS (SELECT cs.*, {assign_expr('cs.user_id', "'retrieval_v1'")} AS variant FROM cs JOIN cfg ON cfg.experiment_id = 'retrieval_v1' WHERE cs.cand_rank <= 10)"]

ORACLE["list_diversity"] = with_(_SERVED + [
    "per AS (SELECT sl.user_id, sl.variant, count(DISTINCT ig.genre) AS n_genres FROM sl LEFT JOIN ig USING (item_id) GROUP BY 1, 2)"], """
SELECT variant, count(*) AS n_lists, round(quantile_disc(CAST(n_genres AS DOUBLE), 0.5), 6) AS median_genres, round(avg(n_genres), 6) AS mean_genres
FROM per GROUP BY variant""")

ORACLE["selection_concentration"] = with_(_SERVED + [FB,
    "pr AS (SELECT item_id, rank() OVER (ORDER BY n DESC) AS popularity_rank FROM (SELECT item_id, count(*) AS n FROM fb GROUP BY item_id))"], """
SELECT CASE WHEN pr.popularity_rank <= 100 THEN 'top_100' WHEN pr.popularity_rank <= 1000 THEN 'top_1000' ELSE 'tail' END AS item_bucket,
  count(*) AS selections FROM sl LEFT JOIN pr USING (item_id) GROUP BY 1""")

ORACLE["data_gate"] = with_([f"r AS ({RATINGS})"], """
SELECT count(*) AS n_interactions, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, max(ts) AS latest,
  CAST(floor((epoch_us((SELECT max(ts) FROM r)) - epoch_us(max(ts))) / 86400000000.0) AS BIGINT) AS data_age_days,
  count(*) >= 100000 AS passed FROM r""")

_RUNS = _CS + [FB, POST.format(src="fb"), ARM,
               "popn AS (SELECT item_id, CAST(count(*) AS DOUBLE) AS popularity FROM fb GROUP BY item_id)",
               """mr AS (SELECT cs.*, coalesce(arm.expected_ctr, 0.0) AS expected_ctr, coalesce(popn.popularity, 0.0) AS popularity
                      FROM cs LEFT JOIN arm USING (item_id) LEFT JOIN popn USING (item_id))"""]
for _i, (_name, _col) in enumerate((("retrieval", "score"), ("bandit", "expected_ctr"), ("popularity", "popularity")), 1):
    _RUNS += _gm_renamed(f"r{_i}", "mr", _col)
_RUNS += ["""runs AS (SELECT CAST(1 AS BIGINT) AS run_id, 'ranker' AS model, 'retrieval' AS scorer, ndcg_10, hr_10, mrr_10, (SELECT max(ts) FROM fb) AS start_time FROM r1m
             UNION ALL SELECT 2, 'ranker', 'bandit', ndcg_10, hr_10, mrr_10, (SELECT max(ts) FROM fb) FROM r2m
             UNION ALL SELECT 3, 'ranker', 'popularity', ndcg_10, hr_10, mrr_10, (SELECT max(ts) FROM fb) FROM r3m)"""]

ORACLE["quality_gate"] = with_(_RUNS + ["prod AS (SELECT model, ndcg_10 AS prod_ndcg FROM runs WHERE scorer = 'popularity')"], """
SELECT r.run_id, r.model, round(r.ndcg_10, 6) AS ndcg_10, round(p.prod_ndcg, 6) AS prod_ndcg,
  round(round((r.ndcg_10 - p.prod_ndcg) / greatest(p.prod_ndcg, 1e-6) * 100.0, 2), 6) AS improvement_pct,
  CASE WHEN r.ndcg_10 IS NULL THEN 'failed'
       WHEN r.ndcg_10 < 0.8 THEN 'quality_gate_failed'
       WHEN p.prod_ndcg IS NULL OR (r.ndcg_10 - p.prod_ndcg) / greatest(p.prod_ndcg, 1e-6) >= 0.01 THEN 'promoted'
       ELSE 'not_improved' END AS status
FROM runs r LEFT JOIN prod p USING (model) WHERE r.scorer <> 'popularity'""")

ORACLE["best_run"] = with_(_RUNS, """
SELECT b.model, b.best_run_id, round(b.best_ndcg_10, 6) AS best_ndcg_10, l.last_run_id FROM
  (SELECT model, arg_max(run_id, ndcg_10 * 1e6 + run_id * 1e-9) AS best_run_id, max(ndcg_10) AS best_ndcg_10 FROM runs WHERE ndcg_10 > 0 GROUP BY model) b
  JOIN (SELECT model, run_id AS last_run_id FROM (SELECT *, row_number() OVER (ORDER BY start_time DESC, run_id DESC) AS r FROM runs) WHERE r = 1) l USING (model)""")

ORACLE["recent_runs"] = with_(_RUNS, """
SELECT run_id, model, scorer, round(ndcg_10, 6) AS ndcg_10, round(hr_10, 6) AS hr_10, round(mrr_10, 6) AS mrr_10, start_time,
  CAST(row_number() OVER (PARTITION BY model ORDER BY start_time DESC, run_id DESC) AS BIGINT) AS recency FROM runs""")

ORACLE["version_transition"] = with_(_RUNS, """
SELECT model, run_id AS version, CASE WHEN scorer = 'popularity' THEN 'Production' ELSE 'None' END AS stage,
  CASE WHEN run_id = max(run_id) OVER (PARTITION BY model) THEN 'Production'
       WHEN scorer = 'popularity' THEN 'Archived' ELSE 'None' END AS new_stage FROM runs""")

ORACLE["health_rollup"] = with_(SNAPS + [REQ,
    "fr AS (SELECT CASE WHEN (epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(event_timestamp))) / 86400000000.0 < 30 THEN 'ok' ELSE 'down' END AS status FROM snaps)",
    """sv AS (SELECT CASE WHEN quantile_disc(latency_ms, 0.95) <= 200.0 AND count(*) FILTER (WHERE status >= 500) / count(*) * 100.0 <= 1.0
             THEN 'ok' ELSE 'down' END AS status FROM req)""",
    "cp AS (SELECT status FROM fr UNION ALL SELECT status FROM sv)"], """
SELECT count(*) AS n_components, CASE WHEN bool_or(status = 'down') THEN 'degraded' ELSE 'healthy' END AS overall FROM cp""")

ORACLE["metric_names"] = with_(_CS + [_RF] + _group_metrics("rf", "rank_norm"), """
SELECT metric, round(value, 6) AS value, regexp_replace(replace(metric, '@', '_at_'), '[^A-Za-z0-9_\\-./ ]', '_', 'g') AS safe_name FROM (
  SELECT 'ndcg@5' AS metric, ndcg_5 AS value FROM gm UNION ALL SELECT 'hr@5', hr_5 FROM gm UNION ALL SELECT 'mrr@5', mrr_5 FROM gm
  UNION ALL SELECT 'ndcg@10', ndcg_10 FROM gm UNION ALL SELECT 'hit rate@10', hr_10 FROM gm UNION ALL SELECT 'mrr(10)', mrr_10 FROM gm)""")

# ---- step 9: search ----------------------------------------------------------------------------------------


def _norm_sql(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce({x}, ''))), '\\s*\\(\\d{{4}}\\)$', ''), "
            f"'[^a-z0-9]+', ' ', 'g'), '\\s+', ' ', 'g'))")


_SEARCH = [f"it AS ({ITEMS})", f"cat AS (SELECT item_id, title, {_norm_sql('title')} AS normalized FROM it)",
           "names AS (SELECT DISTINCT p_name FROM part)",
           """qs AS (SELECT 'full:' || p_name AS query_id, p_name AS query_text FROM names
                UNION ALL SELECT 'prefix:' || p_name, substr(p_name, 1, length(p_name) - 2) FROM names
                UNION ALL SELECT 'token:' || p_name, string_split(p_name, ' ')[2] FROM names
                UNION ALL SELECT 'typo:' || p_name, replace(p_name, 'e', 'a') FROM names)""",
           f"q AS (SELECT query_id, {_norm_sql('query_text')} AS query FROM qs WHERE query_text IS NOT NULL)",
           "q2 AS (SELECT * FROM q WHERE query <> '')"]

ORACLE["title_normalize"] = with_(_SEARCH[:2], "SELECT item_id, title, normalized FROM cat")

_TIERS = _SEARCH + [
    "ex AS (SELECT q2.query_id, c.item_id, c.title, 0 AS tier, 0 AS neg, 0 AS ln, '' AS lt FROM q2 JOIN cat c ON c.normalized = q2.query)",
    """sc AS (SELECT q2.query_id, c.item_id, c.title, c.normalized,
              CASE WHEN starts_with(c.normalized, q2.query) THEN 300 - greatest(0, length(c.normalized) - length(q2.query))
                   WHEN instr(c.normalized, q2.query) > 0 THEN 220 - (instr(c.normalized, q2.query) - 1)
                   WHEN list_bool_and(list_transform(string_split(q2.query, ' '), lambda qt:
                        list_bool_or(list_transform(string_split(c.normalized, ' '), lambda t: starts_with(t, qt))))) THEN 180
                   ELSE 0 END AS score FROM q2, cat c)""",
    "pa AS (SELECT query_id, item_id, title, 1 AS tier, -score AS neg, length(normalized) AS ln, lower(title) AS lt FROM sc WHERE score > 0)",
    "al AS (SELECT * FROM ex UNION ALL SELECT * FROM pa)",
    """dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, item_id ORDER BY tier, neg, ln, lt) AS d FROM al) WHERE d = 1)""",
    """ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY tier, neg, ln, lt, item_id) AS position FROM dd)"""]

ORACLE["title_suggest"] = with_(_TIERS, """
SELECT query_id, CAST(position AS BIGINT) AS position, item_id, title, tier, -neg AS score FROM ranked WHERE position <= 8""")


# The longest common block of a and b as one number: length * 100000 - start in a (the earliest start wins).
_BLOCK = """(SELECT max(k * 100000 - i) FROM (SELECT unnest(range(1, length({a}) + 1)) AS i) x,
             (SELECT unnest(range(1, length({a}) + 1)) AS k) y WHERE i + k - 1 <= length({a}) AND contains({b}, substr({a}, i, k)))"""


def _fuzzy_ctes(limit: int) -> list:
    """Tiered matches, then items of the closest keys: matching blocks by recursion to both sides."""
    n_keys = max(2 * limit, 10)
    return ["RECURSIVE " + _TIERS[0]] + _TIERS[1:] + [
        f"found AS (SELECT * FROM ranked WHERE position <= {limit})",
        f"need AS (SELECT * FROM q2 WHERE (SELECT count(*) FROM found f WHERE f.query_id = q2.query_id) < {limit})",
        """pr AS (SELECT * FROM (SELECT DISTINCT query FROM need), (SELECT DISTINCT normalized FROM cat WHERE normalized <> '')
                 WHERE 2.0 * least(length(query), length(normalized)) / (length(query) + length(normalized)) >= 0.65)""",
        f"""seg AS (SELECT query, normalized, normalized AS a, query AS b, {_BLOCK.format(a='normalized', b='query')} AS s FROM pr
          UNION ALL
          SELECT query, normalized, a, b, {_BLOCK.format(a='a', b='b')} AS s FROM (
            SELECT query, normalized, CASE WHEN side = 0 THEN substr(a, 1, i - 1) ELSE substr(a, i + k) END AS a,
                   CASE WHEN side = 0 THEN substr(b, 1, j - 1) ELSE substr(b, j + k) END AS b
            FROM (SELECT *, instr(b, substr(a, i, k)) AS j FROM (
                    SELECT *, k * 100000 - s AS i FROM (SELECT *, CAST(ceil(s / 100000.0) AS BIGINT) AS k FROM seg WHERE s IS NOT NULL))),
                 (VALUES (0), (1)) z(side))
          WHERE a <> '' AND b <> '')""",
        """rt AS (SELECT query, normalized, 2.0 * sum(coalesce(ceil(s / 100000.0), 0)) / (length(query) + length(normalized)) AS ratio
                 FROM seg GROUP BY query, normalized)""",
        """kr AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY ratio DESC, normalized DESC) AS key_rank
                 FROM rt WHERE ratio >= 0.65)""",
        f"""fz AS (SELECT n.query_id, c.item_id, c.title, 1 AS o1, kr.key_rank AS o2, c.item_id AS o3
                 FROM need n JOIN kr USING (query) JOIN cat c USING (normalized) WHERE kr.key_rank <= {n_keys})""",
        """both_ AS (SELECT query_id, item_id, title, 0 AS o1, position AS o2, 0 AS o3 FROM found UNION ALL SELECT * FROM fz)""",
        """one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, item_id ORDER BY o1, o2, o3) AS d FROM both_)
                  WHERE d = 1)""",
        """hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY o1, o2, o3) AS place FROM one)"""]


ORACLE["title_fuzzy"] = with_(_fuzzy_ctes(8), """
SELECT query_id, CAST(place AS BIGINT) AS position, item_id, title FROM hits WHERE place <= 8""")

ORACLE["movie_seed_recommend"] = with_(_fuzzy_ctes(1) + [VEC,
    """sd AS (SELECT h.query_id, h.item_id AS matched_item, coalesce(a.item_id, b.item_id, c.item_id) AS resolved_id
              FROM hits h LEFT JOIN vx a ON a.item_id = h.item_id LEFT JOIN vx b ON b.item_id = h.item_id + 1
              LEFT JOIN vx c ON c.item_id = h.item_id - 1 WHERE h.place = 1)""",
    """sm AS (SELECT * FROM (SELECT a.item_id AS seed, b.item_id, list_dot_product(a.v, b.v) AS score,
                row_number() OVER (PARTITION BY a.item_id ORDER BY list_dot_product(a.v, b.v) DESC, b.item_id) AS rank
              FROM vx a, vx b WHERE a.item_id <> b.item_id AND a.item_id IN (SELECT resolved_id FROM sd)) WHERE rank <= 10)"""], """
SELECT sd.query_id, sd.matched_item, sd.resolved_id, CAST(sm.rank AS BIGINT) AS rank, sm.item_id,
  round(greatest(0.0, least(1.0, (sm.score + 1.0) / 2.0)), 4) AS similarity, it.title
FROM sd JOIN sm ON sm.seed = sd.resolved_id LEFT JOIN it ON it.item_id = sm.item_id""")

# ---- step 6: negatives ------------------------------------------------------------------------------------


def _h60(*parts) -> str:
    inner = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return "(('0x' || substr(md5(concat_ws(':', " + inner + ")), 1, 15))::BIGINT)"


_CATPOS = "catpos AS (SELECT p_partkey AS item_id, row_number() OVER (ORDER BY p_partkey) AS item_pos FROM part)"
_NCAT = "(SELECT count(*) FROM catpos)"


def _uniform_sql(keys_cte: str, key_cols: list, seen_cte: str, n: int, seed: int, draws: int, replace: bool = True) -> list:
    kc = ", ".join(f"k.{c}" for c in key_cols)
    kc_plain = ", ".join(key_cols)
    ctes = [f"""dr AS (SELECT {kc}, d.draw, ({_h60(*[f'k.{c}' for c in key_cols], 'd.draw', seed)} % {_NCAT}) + 1 AS item_pos
                  FROM (SELECT DISTINCT {kc_plain} FROM {keys_cte}) k, (SELECT unnest(range(1, {draws + 1})) AS draw) d)""",
            f"""ac AS (SELECT dr.*, catpos.item_id FROM dr JOIN catpos USING (item_pos)
                  WHERE NOT EXISTS (SELECT 1 FROM {seen_cte} s WHERE s.user_id = dr.user_id AND s.item_id = catpos.item_id))"""]
    if not replace:
        ctes.append(f"ac2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {kc_plain}, item_id ORDER BY draw) AS q FROM ac) WHERE q = 1)")
    src = "ac2" if not replace else "ac"
    ctes.append(f"""neg AS (SELECT {kc_plain}, CAST(neg_rank AS BIGINT) AS neg_rank, draw, item_id FROM (
                  SELECT *, row_number() OVER (PARTITION BY {kc_plain} ORDER BY draw) AS neg_rank FROM {src}) WHERE neg_rank <= {n})""")
    return ctes


ORACLE["negatives_uniform"] = with_(_KC + [_CATPOS] + _uniform_sql(_CORE, ["user_id"], _CORE, 10, 42, 200),
                                    "SELECT * FROM neg")
ORACLE["negatives_batch"] = with_(_KC + [_CATPOS] + _uniform_sql(_CORE, ["user_id"], _CORE, 1, 7, 100),
                                  "SELECT * FROM neg")
ORACLE["negatives_per_position"] = with_(_KC + [_CATPOS,
    f"kp AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, tie) AS BIGINT) AS pos FROM {_CORE})"] +
    _uniform_sql("kp", ["user_id", "pos"], _CORE, 128, 42, 512), "SELECT * FROM neg")

ORACLE["negatives_popularity"] = with_(_KC + [
    f"cnt AS (SELECT item_id, count(*) AS cnt FROM {_CORE} GROUP BY item_id)",
    "cdf AS (SELECT item_id, cnt, sum(cnt) OVER (ORDER BY item_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_hi FROM cnt)",
    f"""dr AS (SELECT k.user_id, d.draw, {_h60('k.user_id', 'd.draw', 42)} % (SELECT sum(cnt) FROM cnt) AS t
              FROM (SELECT DISTINCT user_id FROM {_CORE}) k, (SELECT unnest(range(1, 201)) AS draw) d)""",
    f"""ac AS (SELECT dr.user_id, dr.draw, cdf.item_id FROM dr JOIN cdf ON dr.t >= cdf.cum_hi - cdf.cnt AND dr.t < cdf.cum_hi
              WHERE NOT EXISTS (SELECT 1 FROM {_CORE} s WHERE s.user_id = dr.user_id AND s.item_id = cdf.item_id))"""], """
SELECT user_id, CAST(neg_rank AS BIGINT) AS neg_rank, draw, item_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY draw) AS neg_rank FROM ac) WHERE neg_rank <= 10""")

ORACLE["pit_samples"] = with_([_CATPOS,
    """ei AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, ts, event_id AS tie
           FROM events WHERE event_type IN ('click', 'purchase', 'view'))""",
    "lr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS r FROM ei)",
    "lastev AS (SELECT user_id, item_id, ts FROM lr WHERE r = 1 AND user_id IN (SELECT user_id FROM lr WHERE r = 2))"] +
    _uniform_sql("lastev", ["user_id"], "ei", 4, 42, 100, replace=False), """
SELECT user_id, item_id, ts, 1 AS label FROM lastev
UNION ALL SELECT neg.user_id, neg.item_id, lastev.ts, 0 FROM neg JOIN lastev USING (user_id)""")

ORACLE["sampled_eval"] = with_(_kcore_holdout() + [_CATPOS] + _uniform_sql("target", ["user_id"], "(SELECT * FROM target WHERE false)", 100, 42, 100) + [
    "pop AS (SELECT item_id, CAST(count(*) AS DOUBLE) AS score FROM hist GROUP BY item_id)",
    "ts_ AS (SELECT t.user_id, coalesce(p.score, 0.0) AS s FROM target t LEFT JOIN pop p USING (item_id))",
    """ranks AS (SELECT n.user_id, 1 + count(*) FILTER (WHERE coalesce(p.score, 0.0) > ts_.s) AS rnk
               FROM neg n LEFT JOIN pop p USING (item_id) JOIN ts_ USING (user_id) GROUP BY n.user_id)"""],
    metric_bundle_sql("ranks", ks=(1, 5, 10)))

# ---- step 6b: full-ranking evaluation -----------------------------------------------------------------------
ORACLE["full_ranking_eval"] = with_([VEC, EVI,
    "lr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM evi)",
    "hist AS (SELECT * FROM lr WHERE rn > 1)", "tgt AS (SELECT user_id, item_id AS target_id FROM lr WHERE rn = 1)"] + _pool("hist") + [
    """ranks AS (SELECT uv.user_id, 1 + count(*) FILTER (WHERE (list_dot_product(uv.v, vx.v) > list_dot_product(uv.v, tv.v)
                 OR (list_dot_product(uv.v, vx.v) = list_dot_product(uv.v, tv.v) AND vx.item_id < t.target_id))
                 AND vx.item_id <> t.target_id
                 AND NOT EXISTS (SELECT 1 FROM hist h WHERE h.user_id = uv.user_id AND h.item_id = vx.item_id)) AS rnk
               FROM uv JOIN tgt t USING (user_id) JOIN vx tv ON tv.item_id = t.target_id CROSS JOIN vx GROUP BY uv.user_id)"""],
    metric_bundle_sql("ranks", ks=(5, 10, 20)))

# ---- step 10: streaming (final sink state vs batch SQL) ----------------------------------------------------
ORACLE["stream_ingest"] = with_([CFG,
    f"""fb2 AS (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
           CASE WHEN event_type = 'view' THEN 0.0 ELSE 1.0 END AS reward FROM events WHERE event_type IN ('click', 'purchase', 'view'))"""], f"""
SELECT event_id, user_id, item_id, reward, reward > 0 AS clicked,
  coalesce(user_id >= 0 AND item_id IS NOT NULL AND item_id >= 0 AND reward IN (0.0, 1.0), false) AS valid,
  {assign_expr('fb2.user_id', "'retrieval_v1'")} AS variant, 'retrieval_v1' AS experiment_id
FROM fb2 JOIN cfg ON cfg.experiment_id = 'retrieval_v1'""")

ORACLE["stream_bandit"] = with_([FB, POST.format(src="fb")], "SELECT item_id, round(alpha, 6) AS alpha, round(beta, 6) AS beta FROM post")

ORACLE["stream_ctr"] = with_([CFG,
    f"""cw AS (SELECT time_bucket(INTERVAL 1 DAY, e.ts) AS window_start, {assign_expr('e.user_id', "'retrieval_v1'")} AS variant,
            count(*) FILTER (WHERE e.event_type = 'view') AS exposures, count(*) FILTER (WHERE e.event_type = 'click') AS conversions
          FROM events e JOIN cfg ON cfg.experiment_id = 'retrieval_v1' WHERE e.event_type IN ('view', 'click') GROUP BY 1, 2)"""], """
SELECT window_start, variant, exposures, conversions,
  round(CASE WHEN exposures > 0 THEN conversions / exposures ELSE 0.0 END, 6) AS ctr FROM cw""")

ORACLE["stream_latency"] = with_([
    "sw AS (SELECT e.*, time_bucket(INTERVAL 1 MINUTE, e.ts) - k * INTERVAL 1 MINUTE AS window_start FROM events e, (SELECT unnest(range(0, 5)) AS k))",
    "g AS (SELECT window_start, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors, [" +
    ", ".join(f"count(*) FILTER (WHERE value / 1000.0 <= {le})" for le in _LES) + "] AS cums FROM sw GROUP BY 1)"],
    f"SELECT window_start, n, errors, {_hq(0.95)} AS q95 FROM g")

ORACLE["stream_refresh_users"] = """
SELECT user_id, time_bucket(INTERVAL 300 SECOND, ts) AS window_start, min(ts) AS invalidated_at
FROM events WHERE event_type IN ('click', 'purchase', 'view') GROUP BY 1, 2"""

ORACLE["stream_sessions"] = """
WITH g AS (SELECT *, sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 3600000000 THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
           FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events))
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end, count(*) AS n_events FROM g GROUP BY user_id, sid"""

ORACLE["stream_dedup"] = "SELECT event_id, user_id, ts, event_type FROM events"

ORACLE["stream_cache_ttl"] = """
WITH RECURSIVE v AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'view'),
f AS (SELECT user_id, event_id, ts FROM events WHERE event_type IN ('click', 'purchase')),
dropped AS (SELECT v.user_id, v.event_id, v.ts, min({'t': f.ts, 'i': f.event_id}) FILTER (WHERE f.event_id IS NOT NULL) AS d FROM v LEFT JOIN f
  ON f.user_id = v.user_id AND (f.ts > v.ts OR f.ts = v.ts AND f.event_id > v.event_id) AND f.ts < v.ts + INTERVAL 300 SECOND
  GROUP BY ALL),
life AS (SELECT user_id, event_id, ts, coalesce(d, {'t': ts + INTERVAL 300 SECOND, 'i': CAST(-1 AS BIGINT)}) AS e,
  CASE WHEN d IS NULL THEN 'expired' ELSE 'invalidated' END AS reason FROM dropped),
life2 AS (SELECT l.user_id, l.event_id, l.ts, l.e, l.reason,
    min({'t': w.ts, 'i': w.event_id}) FILTER (WHERE {'t': w.ts, 'i': w.event_id} > l.e) AS nxt,
    count(w.event_id) FILTER (WHERE {'t': w.ts, 'i': w.event_id} > {'t': l.ts, 'i': l.event_id} AND {'t': w.ts, 'i': w.event_id} < l.e) AS hits
  FROM life l JOIN v w ON w.user_id = l.user_id GROUP BY ALL),
chain AS (SELECT min({'t': ts, 'i': event_id}).i AS id FROM v GROUP BY user_id
  UNION ALL SELECT life2.nxt.i FROM chain JOIN life2 ON life2.event_id = chain.id WHERE life2.nxt IS NOT NULL)
SELECT user_id, ts AS written_at, e.t AS ended_at, reason, hits FROM chain JOIN life2 ON event_id = id"""

ORACLE["stream_alerts"] = ORACLE["alert_islands"]

ORACLE["stream_attribution"] = with_([CFG], f"""
SELECT c.event_id AS conversion_id, c.user_id, c.ts AS conversion_ts, e.event_id AS exposure_id, e.ts AS exposure_ts,
  CASE WHEN e.event_id IS NULL THEN 'unknown' ELSE {assign_expr('c.user_id', "'retrieval_v1'")} END AS variant
FROM events c JOIN cfg ON cfg.experiment_id = 'retrieval_v1' LEFT JOIN events e
  ON e.user_id = c.user_id AND e.event_type = 'view' AND c.ts >= e.ts AND c.ts <= e.ts + INTERVAL 1 HOUR
WHERE c.event_type = 'click'
QUALIFY row_number() OVER (PARTITION BY c.event_id ORDER BY e.ts DESC NULLS LAST, e.event_id DESC) = 1""")

ORACLE["stream_attribution_pairs"] = """
SELECT c.event_id AS conversion_id, e.event_id AS exposure_id, c.user_id, c.ts AS conversion_ts, e.ts AS exposure_ts
FROM events c JOIN events e ON e.user_id = c.user_id AND c.ts >= e.ts AND c.ts <= e.ts + INTERVAL 1 HOUR
WHERE c.event_type = 'click' AND e.event_type = 'view'"""

# ---- sources and sinks, remaining inventory ---------------------------------------------------------------------
ORACLE["ratings_csv_roundtrip"] = with_([f"r AS ({RATINGS})"],
    "SELECT user_id, item_id, round(CAST(CAST(rating AS FLOAT) AS DOUBLE), 6) AS rating, ts FROM r")
ORACLE["items_csv_roundtrip"] = ITEMS
ORACLE["event_log_roundtrip"] = with_(_STATS[:2], """
SELECT user_id, variant, experiment_id, 10 AS n_recs, round(epoch_us(ts) / 1e6, 6) AS ts, event_id, CAST(0 AS BIGINT) AS n_bad_lines FROM ex""")
ORACLE["request_log_roundtrip"] = ORACLE["latency_sla"]
ORACLE["feature_store_write"] = ORACLE["user_features_full"]
ORACLE["training_samples"] = ORACLE["prefix_samples"].replace(
    "SELECT t.user_id, CAST(t.pos AS BIGINT) AS pos, t.item_id AS target_item, count(*) AS prefix_len,\n       string_agg(CAST(h.item_id AS VARCHAR), ',' ORDER BY h.pos) AS prefix",
    "SELECT t.user_id, string_agg(CAST(h.item_id AS VARCHAR), ',' ORDER BY h.pos) AS input_seq, t.item_id AS target")
ORACLE["report_roundtrip"] = ORACLE["popularity_eval"]
ORACLE["loadtest_stats"] = with_([REQ, "span AS (SELECT (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6 AS s FROM req)",
    """g AS (SELECT CASE WHEN grouping(path) = 1 THEN 'Aggregated' ELSE path END AS name, count(*) AS requests,
             count(*) FILTER (WHERE status >= 500) AS failures, quantile_disc(latency_ms, 0.95) AS p95_ms FROM req GROUP BY ROLLUP (path))"""], """
SELECT name, requests, failures, round(CASE WHEN span.s > 0 THEN requests / span.s ELSE 0.0 END, 6) AS rps, round(p95_ms, 6) AS p95_ms,
  p95_ms <= 200.0 AS p95_ok, failures / greatest(requests, 1) * 100.0 <= 1.0 AS errors_ok FROM g, span""")

ORACLE["rank_distribution"] = ORACLE["full_ranking_eval"][:ORACLE["full_ranking_eval"].rindex("SELECT CAST(ks.k")] + """
SELECT CAST(c.cutoff AS BIGINT) AS cutoff, count(*) FILTER (WHERE rnk <= c.cutoff) AS n_within,
  round(count(*) FILTER (WHERE rnk <= c.cutoff) / count(*) * 100.0, 6) AS pct_within, min(rnk) AS min_rank, max(rnk) AS max_rank,
  round(avg(rnk), 6) AS mean_rank, round(quantile_cont(CAST(rnk AS DOUBLE), 0.5), 6) AS median_rank
FROM ranks, (VALUES (1), (3), (5), (10), (20), (50), (100), (200)) c(cutoff) GROUP BY c.cutoff"""


def _pop_ranks(hist: str, tgt: str, name: str) -> list:
    return [f"{name}_pop AS (SELECT item_id, count(*) AS pop FROM {hist} GROUP BY item_id)",
            f"{name}_tp AS (SELECT t.user_id, t.item_id, coalesce(p.pop, 0) AS pt FROM {tgt} t LEFT JOIN {name}_pop p USING (item_id))",
            f"""{name}_r AS (SELECT tp.user_id, 1 + (SELECT count(*) FROM {name}_pop pp WHERE pp.pop > tp.pt AND pp.item_id NOT IN
                  (SELECT h.item_id FROM {hist} h WHERE h.user_id = tp.user_id)) AS rnk FROM {name}_tp tp)""",
            f"""{name}_m AS (SELECT avg(CASE WHEN rnk <= 10 THEN 1.0 ELSE 0.0 END) AS hr_10,
                  avg(CASE WHEN rnk <= 10 THEN 1.0 / log2(rnk + 1.0) ELSE 0.0 END) AS ndcg_10,
                  avg(CASE WHEN rnk <= 10 THEN 1.0 / rnk ELSE 0.0 END) AS mrr_10 FROM {name}_r)"""]


ORACLE["val_test_pivot"] = with_(_KC + [
    f"lr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM {_CORE})",
    "tr AS (SELECT * FROM lr WHERE rn > 2)", "va AS (SELECT * FROM lr WHERE rn = 2)", "te AS (SELECT * FROM lr WHERE rn = 1)",
    "trva AS (SELECT * FROM lr WHERE rn > 1)"] + _pop_ranks("tr", "va", "v") + _pop_ranks("trva", "te", "t"), """
SELECT 'hr_10' AS metric, round(v_m.hr_10, 6) AS val, round(t_m.hr_10, 6) AS test FROM v_m, t_m
UNION ALL SELECT 'ndcg_10', round(v_m.ndcg_10, 6), round(t_m.ndcg_10, 6) FROM v_m, t_m
UNION ALL SELECT 'mrr_10', round(v_m.mrr_10, 6), round(t_m.mrr_10, 6) FROM v_m, t_m""")

ORACLE["decode_ids"] = with_(_KC + [
    f"umap AS (SELECT user_id, row_number() OVER (ORDER BY user_id) AS user_idx FROM (SELECT DISTINCT user_id FROM {_CORE}))"], """
SELECT e.user_idx, coalesce(CAST(umap.user_id AS VARCHAR), 'Unknown_' || CAST(e.user_idx AS VARCHAR)) AS raw_id
FROM (SELECT DISTINCT user_id AS user_idx FROM events) e LEFT JOIN umap USING (user_idx)""")

ORACLE["cap_users"] = with_(_KC + [f"cu AS MATERIALIZED (SELECT DISTINCT user_id FROM {_CORE})",
                                   f"ch AS (SELECT user_id, {_h60('user_id', 42)} AS h FROM cu)"],
                            "SELECT user_id FROM ch ORDER BY h, user_id LIMIT 100")

ORACLE["label_coverage"] = with_([EVI,
    "lr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM evi)",
    "lab AS (SELECT DISTINCT user_id FROM lr WHERE rn = 1)", "sq AS (SELECT DISTINCT user_id FROM lr WHERE rn > 1)"], """
SELECT (SELECT count(*) FROM lab) AS n_label_users, (SELECT count(*) FROM sq) AS n_sequence_users,
  (SELECT count(*) FROM lab JOIN sq USING (user_id)) AS n_both,
  (SELECT count(*) FROM lab WHERE user_id NOT IN (SELECT user_id FROM sq)) AS n_missing""")

_DEF = dict(_USER_DEFAULTS)


def _served(name):
    return f"coalesce(CAST(uf.{name} AS DOUBLE), {_DEF[name]})"


ORACLE["serving_alignment"] = with_(_USER_FEAT, f"""SELECT CAST(c.c_custkey AS DOUBLE) AS user_id,
  round(ln(1 + {_served('total_interactions')}), 6) AS u_user_rating_count, round({_served('avg_rating')}, 6) AS u_user_avg_rating,
  round({_served('recency_days')}, 6) AS u_user_days_since_last, 0.0 AS u_user_sequence_length,
  round({_served('active_days')}, 6) AS i_item_active_days, round({_served('total_interactions')}, 6) AS i_item_rating_count,
  0.0 AS user_last_timestamp, 0.0 AS item_first_timestamp,
  CASE WHEN uf.user_id IS NOT NULL THEN 1.0 ELSE 0.0 END AS found
FROM customer c LEFT JOIN uf ON uf.user_id = c.c_custkey""")

ORACLE["padded_lists"] = with_(_CS + ["mxr AS (SELECT user_id, max(cand_rank) AS m FROM cs GROUP BY user_id)"], """
SELECT user_id, cand_rank, item_id, round(score, 6) AS score FROM cs
UNION ALL SELECT user_id, CAST(r AS BIGINT), CAST(0 AS BIGINT), 0.0 FROM mxr, LATERAL (SELECT unnest(range(m + 1, 101)) AS r)""")

ORACLE["vector_self_check"] = with_([VEC], """
SELECT count(*) AS n_vectors, round(avg(CASE WHEN qid = item_id THEN 1.0 ELSE 0.0 END), 6) AS self_top1_share FROM (
  SELECT a.item_id AS qid, b.item_id, row_number() OVER (PARTITION BY a.item_id ORDER BY list_dot_product(a.v, b.v) DESC, b.item_id) AS rn
  FROM vx a, vx b) WHERE rn = 1""")

# ---- Q6 / Q7 --------------------------------------------------------------------------------------------------
_ITEM_STORE = [
    f"ip_r AS ({RATINGS})", "ip_now AS (SELECT max(ts) AS now FROM ip_r)",
    f"""ip_st AS (SELECT item_id, avg(rating) AS a, count(*) AS c, coalesce(stddev_samp(rating), 0.0) AS s,
          avg(CASE WHEN rating >= 4.0 THEN 1.0 ELSE 0.0 END) AS h, count(*) FILTER (WHERE rating >= 4.0) AS gp,
          greatest({_days('max(ts)', 'min(ts)')}, 1.0) AS ad FROM ip_r GROUP BY item_id)""",
    "ip_rk AS (SELECT item_id, rank() OVER (ORDER BY gp DESC) AS pr FROM ip_st WHERE gp > 0)",
    "ip_g AS (SELECT item_id, count(*) AS gc, arg_min(idx, pos) AS pg FROM ig GROUP BY item_id)",
    """ip_cat AS (SELECT item_id, CASE WHEN yr BETWEEN 1888 AND 2030 THEN yr ELSE 0 END AS ry FROM (
          SELECT item_id, CAST(nullif(regexp_extract(trim(title), '\\((\\d{4})\\)\\s*$', 1), '') AS INTEGER) AS yr FROM it))""",
    """ip AS (SELECT c.item_id, CAST(coalesce(st.gp, 0) AS DOUBLE) AS global_popularity, CAST(coalesce(rk.pr, 99999) AS DOUBLE) AS popularity_rank,
          CASE WHEN st.gp > 0 THEN 1.0 / ln(1 + st.gp) ELSE 1.0 END AS niche_score,
          coalesce(st.c, 0) / greatest(coalesce(st.ad, 1.0), 1.0) AS avg_ratings_per_day, coalesce(st.a, 0.0) AS avg_item_rating,
          CAST(coalesce(st.c, 0) AS DOUBLE) AS rating_count, coalesce(st.s, 0.0) AS rating_std, coalesce(st.h, 0.0) AS high_rating_ratio,
          CAST(coalesce(g.gc, 0) AS DOUBLE) AS genre_count, CAST(coalesce(g.pg, -1) AS DOUBLE) AS primary_genre_idx,
          CAST(coalesce(c.ry, 0) AS DOUBLE) AS release_year,
          CASE WHEN coalesce(c.ry, 0) = 0 THEN 0.0 ELSE CAST(greatest(year(ip_now.now) - c.ry, 0) * 365 AS DOUBLE) END AS item_age_days
        FROM ip_cat c CROSS JOIN ip_now LEFT JOIN ip_g g USING (item_id) LEFT JOIN ip_st st USING (item_id) LEFT JOIN ip_rk rk USING (item_id))"""]

_ITEM_DEFAULTS = [("global_popularity", 0.0), ("popularity_rank", 99999.0), ("niche_score", 1.0), ("avg_ratings_per_day", 0.0),
                  ("avg_item_rating", 3.0), ("rating_count", 0.0), ("rating_std", 0.5), ("high_rating_ratio", 0.5),
                  ("genre_count", 1.0), ("primary_genre_idx", 7.0), ("release_year", 2000.0), ("item_age_days", 8760.0)]

ORACLE["store_matrix"] = with_(_CS + _USER_FEAT + _ITEM_STORE + [
    "prim AS (SELECT item_id, arg_min(idx, pos) AS pg FROM ig GROUP BY item_id)",
    "per AS (SELECT h.user_id, prim.pg, count(*) AS c FROM hist h JOIN prim USING (item_id) GROUP BY 1, 2)",
    "tot AS (SELECT user_id, count(*) AS t FROM hist GROUP BY user_id)"],
    "SELECT cs.user_id, cs.cand_rank, cs.item_id, cs.label, round(cs.score, 6) AS score, " +
    ", ".join(f"round(coalesce(CAST(uf.{c} AS DOUBLE), {v}), 6) AS u_{c}" for c, v in _USER_DEFAULTS) + ", " +
    ", ".join(f"round(coalesce(ip.{c}, {v}), 6) AS i_{c}" for c, v in _ITEM_DEFAULTS) + """,
  round(CASE WHEN tot.t > 0 THEN coalesce(per.c, 0) / tot.t ELSE 0.0 END, 6) AS primary_genre_overlap
FROM cs LEFT JOIN uf ON uf.user_id = cs.user_id LEFT JOIN ip ON ip.item_id = cs.item_id LEFT JOIN prim ON prim.item_id = cs.item_id
LEFT JOIN per ON per.user_id = cs.user_id AND per.pg = prim.pg LEFT JOIN tot ON tot.user_id = cs.user_id""")

ORACLE["serving_matrix"] = with_(_RM + [
    f"v AS ({VOCAB})", f"ig AS (SELECT x.item_id, x.genre, v.idx, x.pos FROM ({IG}) x JOIN v ON v.genre = x.genre)",
    "rec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS r FROM hist) WHERE r <= 50)",
    "prof AS (SELECT rec.user_id, ig.genre, count(*) AS c FROM rec JOIN ig USING (item_id) GROUP BY 1, 2)",
    "share AS (SELECT user_id, genre, c / sum(c) OVER (PARTITION BY user_id) AS s FROM prof)",
    "topg AS (SELECT user_id, genre AS top_genre FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, genre) AS r FROM prof) WHERE r = 1)",
    "ng AS (SELECT item_id, count(*) AS ng FROM ig GROUP BY item_id)",
    """ov AS (SELECT p.user_id, p.item_id, sum(coalesce(share.s, 0.0)) AS sm FROM pairs p JOIN ig USING (item_id)
            LEFT JOIN share ON share.user_id = p.user_id AND share.genre = ig.genre GROUP BY 1, 2)""",
    """same AS (SELECT p.user_id, p.item_id, max(CASE WHEN ig.genre = topg.top_genre THEN 1 ELSE 0 END) AS sm
              FROM pairs p JOIN topg USING (user_id) LEFT JOIN ig USING (item_id) GROUP BY 1, 2)"""], """
SELECT rf.user_id, rf.cand_rank, rf.item_id, round(rf.score, 6) AS faiss_score, round(rf.rank_norm_serve, 6) AS faiss_rank_normalized,
  round(CAST(coalesce(rif.item_log_popularity, rif.item_rating_count, 0.0) AS DOUBLE), 6) AS item_log_popularity,
  round(coalesce(rif.item_avg_rating, 3.0), 6) AS item_avg_rating,
  round(CAST(coalesce(rif.item_rating_count, 0.0) AS DOUBLE), 6) AS item_rating_count_log,
  round(coalesce(rif.item_days_since_last_rating, 730.0), 6) AS item_recency_days,
  round(CAST(coalesce(rif.item_year, 2000.0) AS DOUBLE), 6) AS item_year,
  round(coalesce(rif.item_active_days, 365.0), 6) AS item_active_days,
  round(CAST(coalesce(ruf.user_rating_count, 0.0) AS DOUBLE), 6) AS user_interaction_count_log,
  round(coalesce(ruf.user_avg_rating, 3.5), 6) AS user_avg_rating,
  round(coalesce(ruf.user_days_since_last, 365.0), 6) AS user_recency_days,
  round(CAST(coalesce(ruf.user_sequence_length, 10.0) AS DOUBLE), 6) AS user_seq_length,
  round(CASE WHEN ng.ng > 0 THEN coalesce(ov.sm, 0.0) / ng.ng ELSE 0.0 END, 6) AS genre_overlap,
  CAST(coalesce(same.sm, 0) AS DOUBLE) AS is_same_top_genre, 0.0 AS mf_score
FROM rf LEFT JOIN ruf USING (user_id) LEFT JOIN rif USING (item_id) LEFT JOIN ov USING (user_id, item_id)
LEFT JOIN ng USING (item_id) LEFT JOIN same USING (user_id, item_id)""")

ORACLE["request_increase_24h"] = with_([REQ], """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS requests, count(*) FILTER (WHERE status >= 500) AS errors
FROM req GROUP BY 1""")

_PADDED = _KC + [
    f"rr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, tie DESC) AS rn FROM {_CORE})",
    """ps AS (SELECT user_id, list_concat(list_transform(range(0, CAST(50 - count(*) AS BIGINT)), lambda x: CAST(0 AS BIGINT)),
              list(item_id ORDER BY ts, tie)) AS seq FROM rr WHERE rn <= 50 GROUP BY user_id)"""]

ORACLE["explode_positives"] = with_(_PADDED, """
SELECT user_id, CAST(i AS BIGINT) AS pos, item_id FROM ps, LATERAL (SELECT unnest(ps.seq) AS item_id, unnest(range(1, 51)) AS i)
WHERE item_id <> 0""")

ORACLE["clamped_sequences"] = with_(_PADDED + ["np AS (SELECT count(*) AS n FROM part)"], """
SELECT user_id, array_to_string(list_transform(seq, lambda x: greatest(least(x, np.n - 1), 0)), ',') AS seq FROM ps, np""")

ORACLE["ivf_all_cells"] = ORACLE["vector_topk"]

ORACLE["serving_popularity"] = f"""
SELECT user_id, cand_rank, item_id, round(CASE WHEN hi - lo > 1e-8 THEN (p - lo) / (hi - lo) ELSE 0.0 END, 6) AS popularity_pct
FROM (SELECT user_id, cand_rank, item_id, item_log_popularity AS p, min(item_log_popularity) OVER (PARTITION BY user_id) AS lo,
        max(item_log_popularity) OVER (PARTITION BY user_id) AS hi FROM ({ORACLE["serving_matrix"]}))"""

ORACLE["full_ranking_pessimistic"] = ORACLE["full_ranking_eval"].replace(" AND vx.item_id < t.target_id", "")

ORACLE["bandit_rerank_base"] = with_(_CS + [
    """bl AS (SELECT user_id, cand_rank, item_id, CASE WHEN max(score) OVER w > min(score) OVER w
                THEN (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) ELSE 0.5 END AS blended
              FROM cs WINDOW w AS (PARTITION BY user_id))"""], """
SELECT user_id, cand_rank, item_id, round(blended, 6) AS blended,
  row_number() OVER (PARTITION BY user_id ORDER BY blended DESC, item_id) AS new_rank FROM bl""")

ORACLE["bandit_fallback"] = with_(_CS, """
SELECT user_id, cand_rank, item_id, CASE WHEN cand_rank % 2 = 1 THEN round(score, 6) END AS score,
  round(CASE WHEN cand_rank % 2 = 1 AND score IS NOT NULL THEN score
             ELSE (count(*) OVER (PARTITION BY user_id) - (cand_rank - 1)) / count(*) OVER (PARTITION BY user_id) END, 6)
    AS fallback_score FROM cs""")

ORACLE["bandit_draws"] = with_(_CS, """
SELECT count(*) AS n, count(*) AS n_inside, count(*) AS n_repeated, true AS centred FROM cs""")

ORACLE["feature_cache_roundtrip"] = with_([f"it AS ({ITEMS})",
    """voc AS (SELECT unnest(v) AS genre, unnest(range(0, len(v))) AS place FROM (SELECT
                ['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'] ||
                list_transform(range(1, 14), lambda i: 'Brand#' || CAST(i AS VARCHAR)) AS v))""",
    """pairs AS (SELECT it.item_id, gv.genre FROM it,
                  (SELECT DISTINCT unnest(string_split(genres, '|')) AS genre FROM it) gv WHERE contains(it.genres, gv.genre))"""], """
SELECT CAST(voc.place AS INTEGER) AS place, 'genre_' || replace(replace(voc.genre, ' ', '_'), '-', '_') AS genre_name, count(DISTINCT pairs.item_id) AS n_with,
  (SELECT count(*) FROM it) AS n_items
FROM voc LEFT JOIN pairs ON pairs.genre = voc.genre GROUP BY voc.place, voc.genre""")

ORACLE["id_maps_roundtrip"] = with_(_KC, f"""
SELECT user_id, tie, dense_rank() OVER (ORDER BY item_id) AS item_idx, item_id FROM {_CORE}""")

ORACLE["aligned_ids"] = with_(_KC, f"""
SELECT user_id, tie, dense_rank() OVER (ORDER BY item_id) AS item_idx FROM {_CORE}""")
