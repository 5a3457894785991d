"""Title search (H1-H5): normalisation, tiered partial matching, fuzzy fallback, seeded recommendations.

Partial matching never compares every query with every title.  Queries and titles are
compared by spelling: distinct query texts with distinct lower-case titles, whose items
(``limit`` a spelling) are joined to the best ones.  Candidates come from equi-joins on
short keys that any true match must share; a query is looked up under the one of its keys
that the fewest titles have:
  * substring tier (prefixes too): the substrings of min(3, len) characters of the query;
  * token tier: the prefixes, up to 3 characters, of the query's tokens, which some title
    token must start with.
Each candidate is then verified with the exact predicate, so no match is lost, and only a
query's best spellings leave the task that found them.

The fuzzy fallback compares a stated set of query strings with the distinct titles in
blocks of bounded size (``closest_keys``): exact bounds first, then matching blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalar import normalize_title
from kestrel.plans.ordering import global_position
from kestrel.plans.topk import top_k
from kestrel.session import cut_lineage

GRAM = 3
BLOCK_QUERIES = 1024   # distinct query strings in one block
BLOCK_KEYS = 16384     # distinct titles in one block
SLICE = 128            # query strings of a block compared at once
CELLS = 1 << 22        # cells of a comparison table held at once
CLASS = 1.2            # lengths within this factor share a length class


def normalized_catalogue(items: DataFrame) -> DataFrame:
    """H1: (item_id, title, normalized)."""
    return items.select("item_id", "title", normalize_title(F.col("title")).alias("normalized"))


def _forms(cat: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The catalogue by spelling: distinct lower-case titles (normalized, _lt), their first ``limit``
    distinct items (_lt, item_id, title), those of a whole normalised title (normalized, item_id,
    title), and the most spellings of one item.

    A title's score and place depend on its spelling alone, and among equal places the smaller
    item goes first, so no query returns more items of a spelling than it returns in all.
    """
    spelled = (cat.where(F.col("normalized") != "").groupBy(F.lower("title").alias("_lt"), "item_id")
               .agg(F.first("normalized").alias("normalized"), F.min("title").alias("title")))
    held = cut_lineage(top_k(spelled, ["_lt"], [F.col("item_id").asc()], limit, "_r"))
    named = spelled.groupBy("normalized", "item_id").agg(F.min("title").alias("title"))
    whole = top_k(named, ["normalized"], [F.col("item_id").asc()], limit, "_r").drop("_r")
    most = spelled.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 1
    return held.where(F.col("_r") == 1).select("normalized", "_lt"), held.select("_lt", "item_id", "title"), whole, most


def _grams(text):
    """Distinct substrings of 1 to GRAM characters."""
    at = F.sequence(F.lit(1), F.length(text))
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(GRAM)), lambda n: F.filter(
        F.transform(at, lambda i: F.substr(text, i, n)), lambda g: F.length(g) == n))))


def _starts(text):
    """Distinct prefixes of 1 to GRAM characters of the tokens."""
    return F.array_distinct(F.flatten(F.transform(F.split(text, " "), lambda t: F.transform(
        F.sequence(F.lit(1), F.least(F.length(t), F.lit(GRAM))), lambda n: F.substr(t, F.lit(1), n)))))


def _whole_grams(text):
    """Distinct substrings of min(GRAM, length) characters."""
    n = F.least(F.length(text), F.lit(GRAM))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substr(text, i, n)))


def _by_rarest(q: DataFrame, forms: DataFrame, asked, held) -> DataFrame:
    """(query, _lt, normalized): forms with the one of the query's keys that the fewest forms have.

    Every match has all keys of its query, so any of them finds all matches.
    """
    keyed = forms.select("_lt", "normalized", F.explode(held(F.col("normalized"))).alias("_k"))
    often = keyed.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    # A key that no form has ends the query: nothing matches it.
    rare = (q.select("query", F.explode(asked(F.col("query"))).alias("_k")).join(often, "_k", "left")
            .groupBy("query").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_k").alias("k"))).alias("_r"))
            .where(F.col("_r.n") > 0).select("query", F.col("_r.k").alias("_k")))
    return rare.join(keyed, "_k").select("query", "_lt", "normalized")


def partial_score(query, normalized):
    """H2: prefix 300 - length difference; substring 220 - index; all tokens prefixed 180; else 0."""
    toks_ok = F.forall(F.split(query, " "), lambda qt: F.exists(F.split(normalized, " "), lambda t: t.startswith(qt)))
    return (F.when(normalized.startswith(query), F.lit(300) - F.greatest(F.lit(0), F.length(normalized) - F.length(query)))
            .when(F.position(query, normalized) > 0, F.lit(220) - (F.position(query, normalized) - 1))
            .when(toks_ok, F.lit(180)).otherwise(F.lit(0)))


def suggest(queries: DataFrame, items: DataFrame, limit: int = 8) -> DataFrame:
    """H2 + H3: exact normalised matches first (catalogue order), then partial matches by score desc,
    normalised length, lower-case title; unique items; ``limit`` per query."""
    forms, held, whole, most = _forms(normalized_catalogue(items), limit)
    q = queries.select("query_id", normalize_title(F.col("query_text")).alias("query")).where(F.col("query") != "")
    texts = cut_lineage(q.select("query").distinct())

    def key(tier, score, length, lower):
        return F.struct(tier.alias("tier"), (-score).alias("_neg"), length.alias("_len"), lower.alias("_lt"),
                        F.col("item_id").alias("item_id")).alias("_k")

    rows = texts.join(whole, texts["query"] == whole["normalized"]).select(
        "query", "item_id", "title", key(F.lit(0), F.lit(0), F.lit(0), F.lit("")))
    for asked, keys in ((_whole_grams, _grams), (_starts, _starts)):
        cand = _by_rarest(texts, forms, asked, keys).withColumn("score", partial_score(F.col("query"), F.col("normalized")))
        # Each spelling has an item and each item at most ``most`` spellings: these hold ``limit`` distinct items.
        part = top_k(cand.where(F.col("score") > 0), ["query"],
                     [F.col("score").desc(), F.length("normalized").asc(), F.col("_lt").asc()], limit * most, "_r")
        rows = rows.unionByName(part.join(held, "_lt").select(
            "query", "item_id", "title", key(F.lit(1), F.col("score"), F.length("normalized"), F.col("_lt"))))

    def first(rows, name):
        best = rows.groupBy(name, "item_id").agg(F.min("_k").alias("_k"), F.min_by("title", "_k").alias("title"))
        return top_k(best, [name], [F.col("_k").asc()], limit, "position")

    found = cut_lineage(first(rows, "query"))
    ranked = first(q.join(found, "query").select("query_id", "item_id", "title", "_k"), "query_id")
    return ranked.select("query_id", "position", "item_id", "title", F.col("_k.tier").alias("tier"),
                         (-F.col("_k._neg")).alias("score"))


def _codes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts as one matrix (0 behind a text's end), and their lengths."""
    raw = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
    lengths = np.array([len(r) for r in raw], np.int64)
    out = np.zeros((len(raw), max(1, int(lengths.max(initial=0)))), np.uint32)
    for row, r in zip(out, raw):
        row[:len(r)] = r
    return out, lengths


def _common_subsequence(query: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of one query with every row of ``keys``.

    One bit of a word per query character, all keys at once; the characters of a query
    beyond 63 are counted as matched, so the result is an upper bound there.
    """
    head = query[:63]
    alphabet, code = np.unique(head, return_inverse=True)
    masks = np.zeros(len(alphabet) + 1, np.uint64)
    np.bitwise_or.at(masks, code, np.uint64(1) << np.arange(len(head), dtype=np.uint64))
    at = np.searchsorted(alphabet, keys)
    at[at == len(alphabet)] = 0
    at = np.where(alphabet[at] == keys, at, len(alphabet))
    state = np.full(len(keys), np.uint64(2 ** 64 - 1))
    for step in range(keys.shape[1]):
        hit = state & masks[at[:, step]]
        state = (state + hit) | (state - hit)
    missed = state & np.uint64((1 << len(head)) - 1)
    return len(head) - np.bitwise_count(missed).astype(np.int64) + len(query) - len(head)


def _longest_block(a, b, seg):
    """Longest common block of a[alo:ahi] and b[blo:bhi] for every row of ``seg`` (pair, alo, ahi,
    blo, bhi): its length and starts; the earliest in a, then in b, among equals."""
    pair, alo, ahi, blo, bhi = seg.T
    wide_a, wide_b = int((ahi - alo).max()), int((bhi - blo).max())
    ia, ib = alo[:, None] + np.arange(wide_a), blo[:, None] + np.arange(wide_b)
    sa = np.where(ia < ahi[:, None], a[pair[:, None], np.minimum(ia, a.shape[1] - 1)], 0)
    sb = np.where(ib < bhi[:, None], b[pair[:, None], np.minimum(ib, b.shape[1] - 1)], 0)
    inside = ib < bhi[:, None]
    run = np.zeros((len(seg), wide_b + 1), np.int32)
    size, end_a, end_b = (np.zeros(len(seg), np.int64) for _ in range(3))
    rows = np.arange(len(seg))
    for i in range(wide_a):
        same = (sa[:, i, None] == sb) & inside & (i < ahi - alo)[:, None]
        run[:, 1:] = np.where(same, run[:, :-1] + 1, 0)
        j = run[:, 1:].argmax(axis=1)
        n = run[rows, j + 1]
        better = n > size
        size[better], end_a[better], end_b[better] = n[better], i + 1, j[better] + 1
    return size, alo + end_a - size, blo + end_b - size


def matched_characters(a, len_a, b, len_b) -> np.ndarray:
    """Characters in matching blocks of every pair of rows: the longest common block, then the
    same to its left and to its right.  All pairs advance together, one level of blocks at a time."""
    total = np.zeros(len(a), np.int64)
    seg = np.stack([np.arange(len(a)), np.zeros(len(a), np.int64), len_a, np.zeros(len(a), np.int64), len_b], axis=1)
    while len(seg):
        seg = seg[(seg[:, 2] > seg[:, 1]) & (seg[:, 4] > seg[:, 3])]
        seg = seg[np.argsort(seg[:, 4] - seg[:, 3], kind="stable")]
        found = []
        lo = 0
        while lo < len(seg):
            widest = np.maximum.accumulate((seg[lo:, 2] - seg[lo:, 1]) + (seg[lo:, 4] - seg[lo:, 3]))
            take = max(1, int(np.searchsorted(np.arange(1, len(widest) + 1) * widest, CELLS, side="right")))
            part = seg[lo:lo + take]
            size, at_a, at_b = _longest_block(a, b, part)
            np.add.at(total, part[:, 0], size)
            hit = size > 0
            part, size, at_a, at_b = part[hit], size[hit], at_a[hit], at_b[hit]
            found.append(np.stack([part[:, 0], part[:, 1], at_a, part[:, 3], at_b], axis=1))
            found.append(np.stack([part[:, 0], at_a + size, part[:, 2], at_b + size, part[:, 4]], axis=1))
            lo += take
        seg = np.concatenate(found) if found else seg[:0]
    return total


def _closest(queries, keys, n_keys: int, cutoff: float) -> pd.DataFrame:
    """The ``n_keys`` closest keys of every query of a block with ratio >= cutoff.

    Upper bounds come first (lengths, then common subsequences); the best bounds are verified,
    then only those pairs whose bound reaches the worst ratio a query would keep.
    """
    keys = np.array(sorted(keys, reverse=True), dtype=object)  # equal ratios: larger key first
    kc, kn = _codes(keys)
    queries = list(queries)
    out = []
    for lo in range(0, len(queries), SLICE):
        qs = queries[lo:lo + SLICE]
        qc, qn = _codes(qs)
        rows, cols, bounds = [], [], []
        for r in range(len(qs)):
            near = np.nonzero(2.0 * np.minimum(kn, qn[r]) / (kn + qn[r]) >= cutoff)[0]
            if not len(near):
                continue
            # Padding matches nothing: 0 stands for no query character.
            common = _common_subsequence(qc[r, :qn[r]], kc[near, :max(1, int(kn[near].max()))])
            bound = 2.0 * np.minimum(common, np.minimum(kn[near], qn[r])) / (kn[near] + qn[r])
            ok = bound >= cutoff
            near, bound = near[ok], bound[ok]
            order = np.argsort(-bound, kind="stable")
            rows.append(np.full(len(order), r))
            cols.append(near[order])
            bounds.append(bound[order])
        if not rows:
            continue
        row, col, bound = np.concatenate(rows), np.concatenate(cols), np.concatenate(bounds)
        first = np.searchsorted(row, np.arange(len(qs)))
        early = np.arange(len(row)) - first[row] < n_keys
        ratio = np.full(len(row), -1.0)

        def verify(which):
            for at in range(0, len(which), 8192):
                w = which[at:at + 8192]
                m = matched_characters(kc[col[w], :int(kn[col[w]].max())], kn[col[w]], qc[row[w]], qn[row[w]])
                ratio[w] = 2.0 * m / (kn[col[w]] + qn[row[w]])

        verify(np.nonzero(early)[0])
        # With n_keys verified, a later pair matters only if its bound reaches the least of them.
        least = np.full(len(qs), cutoff)
        many = np.bincount(row, minlength=len(qs)) > n_keys
        worst = np.full(len(qs), np.inf)
        np.minimum.at(worst, row[early], ratio[early])
        least[many] = np.maximum(cutoff, worst[many])
        verify(np.nonzero(~early & (bound >= least[row]))[0])
        keep = np.nonzero(ratio >= cutoff)[0]
        keep = keep[np.lexsort((col[keep], -ratio[keep], row[keep]))]
        start = np.searchsorted(row[keep], np.arange(len(qs)))
        keep = keep[np.arange(len(keep)) - start[row[keep]] < n_keys]
        out.extend(zip([qs[r] for r in row[keep]], keys[col[keep]], ratio[keep]))
    # One frame at the end: joined string columns would come in several chunks.
    return pd.DataFrame(out, columns=["query", "normalized", "ratio"])


def _length_class(n):
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(CLASS))).cast("int")


def _length_blocks(texts: DataFrame, col: str, size: int, block: str) -> DataFrame:
    """Distinct texts numbered by length and cut into blocks of ``size``."""
    d = texts.where(F.length(col) > 0).select(col, F.length(col).alias("_n")).distinct()
    return global_position(d, ["_n", col], "_pos").select(
        col, "_n", F.floor((F.col("_pos") - 1) / F.lit(size)).cast("bigint").alias(block))


def closest_keys(queries: DataFrame, keys: DataFrame, n_keys: int = 16, cutoff: float = 0.65) -> DataFrame:
    """(query, normalized, ratio, key_rank): for every distinct query string the keys of greatest
    matching-block ratio 2 * matched / (both lengths) >= cutoff, equal ratios by key descending.

    ``queries(query)`` is compared with ``keys(normalized)`` in blocks of bounded size, ordered by
    length; blocks whose lengths cannot reach the cutoff never meet.  Each pair of blocks emits at
    most ``n_keys`` rows a query.  Null and empty texts take no part; repeated ones count once.
    """
    q = _length_blocks(queries, "query", BLOCK_QUERIES, "_qb")
    k = _length_blocks(keys, "normalized", BLOCK_KEYS, "_kb")
    reach = (2.0 - cutoff) / cutoff
    # One row per block and length class: bounded by rows / block size + number of classes.
    qs = q.groupBy("_qb").agg(F.min("_n").alias("lo"), F.max("_n").alias("hi")).select("_qb", F.explode(F.sequence(
        _length_class(F.greatest(F.floor(F.col("lo") / F.lit(reach)), F.lit(1))),
        _length_class(F.ceil(F.col("hi") * F.lit(reach))))).alias("_c"))
    ks = k.select("_kb", _length_class(F.col("_n")).alias("_c")).distinct()
    meet = cut_lineage(qs.join(ks, "_c").select("_qb", "_kb").distinct())
    left = q.join(meet, "_qb").select("_qb", "_kb", "query")
    right = k.join(meet, "_kb").select("_qb", "_kb", "normalized")
    near = (left.groupBy("_qb", "_kb").cogroup(right.groupBy("_qb", "_kb"))
            .applyInPandas(lambda a, b: _closest(a["query"], b["normalized"], n_keys, cutoff),
                           "query string, normalized string, ratio double"))
    return top_k(near, ["query"], [F.col("ratio").desc(), F.col("normalized").desc()], n_keys, "key_rank")


def fuzzy(queries: DataFrame, items: DataFrame, limit: int = 8, cutoff: float = 0.65,
          found: DataFrame | None = None, per_key: int | None = None) -> DataFrame:
    """H4: for queries with fewer than ``limit`` tiered matches, the closest normalised keys
    (ratio >= cutoff, at most max(2 * limit, 10) keys, ratio desc then key desc) and their items.

    ``found``: the tiered matches, if they are at hand.  ``per_key``: at most so many items of a
    key, by id; all of them by default.
    """
    cat = normalized_catalogue(items)
    q = queries.select("query_id", normalize_title(F.col("query_text")).alias("query")).where(F.col("query") != "")
    found = suggest(queries, items, limit) if found is None else found
    n = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"))
    need = q.join(n, "query_id", "left").where(F.coalesce("_n", F.lit(0)) < limit).drop("_n")
    close = closest_keys(need.select("query"), cat.select("normalized"), max(limit * 2, 10), cutoff)
    named = cat.select("item_id", "title", "normalized")
    if per_key is not None:
        one = named.groupBy("normalized", "item_id").agg(F.min("title").alias("title"))
        named = top_k(one, ["normalized"], [F.col("item_id").asc()], per_key, "_r").drop("_r")
    return need.join(close, "query").join(named, "normalized").select(
        "query_id", "key_rank", "normalized", "ratio", "item_id", "title")


def suggest_with_fuzzy(queries: DataFrame, items: DataFrame, limit: int = 8) -> DataFrame:
    """H2-H4 combined: tiered matches, then fuzzy items (key rank, catalogue order) until ``limit``."""
    found = cut_lineage(suggest(queries, items, limit))
    s = found.select("query_id", "item_id", "title", F.struct(
        F.lit(0).alias("a"), F.col("position").cast("double").alias("b"), F.lit(0).cast("bigint").alias("c")).alias("_o"))
    # Up to ``limit`` items of a key may have been found already, up to ``limit`` more are returned.
    f = fuzzy(queries, items, limit, found=found, per_key=2 * limit).select("query_id", "item_id", "title", F.struct(
        F.lit(1).alias("a"), F.col("key_rank").cast("double").alias("b"), F.col("item_id").alias("c")).alias("_o"))
    best = s.unionByName(f).groupBy("query_id", "item_id").agg(F.min("_o").alias("_o"), F.first("title").alias("title"))
    return top_k(best, ["query_id"], [F.col("_o").asc()], limit, "position").select("query_id", "position", "item_id", "title")
