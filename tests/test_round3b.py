"""Fuzzy titles, discrete quantiles, cached features, id maps and id bases."""

import difflib
import os
import random
import tempfile

import numpy as np
import pytest

from kestrel.operators import prep
from kestrel.operators import search as srch
from kestrel.plans.ordering import group_quantiles
from kestrel.sources import files as fio


def _texts(seed, n, alphabet="abcde "):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30))) for _ in range(n)]


def test_matching_blocks_against_difflib():
    keys = _texts(1, 150) + ["é漢a" * 3, "x" * 120, ""]
    kc, kn = srch._codes(keys)
    for q in _texts(2, 25) + ["é漢b" * 3, "x" * 90, "a"]:
        qc, qn = srch._codes([q])
        got = srch.matched_characters(kc, kn, np.repeat(qc, len(keys), 0), np.repeat(qn, len(keys)))
        blocks = [difflib.SequenceMatcher(None, k, q, autojunk=False).get_matching_blocks() for k in keys]
        assert got.tolist() == [sum(b.size for b in bs) for bs in blocks]
        assert (srch._common_subsequence(qc[0], kc) >= got).all()   # the bound never loses a pair


@pytest.mark.parametrize("blocks", [(1024, 16384), (7, 11)])
def test_closest_keys_against_difflib(spark, monkeypatch, blocks):
    monkeypatch.setattr(srch, "BLOCK_QUERIES", blocks[0])
    monkeypatch.setattr(srch, "BLOCK_KEYS", blocks[1])
    keys, queries = _texts(3, 120), _texts(4, 30)
    queries += [keys[0], keys[0], keys[1][:-1] or "a", "zzz", ""]
    got = srch.closest_keys(spark.createDataFrame([(q,) for q in queries + [None]], "query string"),
                            spark.createDataFrame([(k,) for k in keys + keys[:9] + ["", None]], "normalized string"), 5, 0.55)
    by_query = {}
    for r in got.orderBy("query", "key_rank").collect():
        by_query.setdefault(r.query, []).append(r.normalized)
    for q in set(queries):
        assert by_query.get(q, []) == (difflib.get_close_matches(q, sorted(set(keys)), 5, 0.55) if q else [])
    empty = srch.closest_keys(spark.createDataFrame([], "query string"), spark.createDataFrame([("a",)], "normalized string"))
    assert empty.count() == 0


def test_discrete_quantiles(spark):
    rnd = random.Random(5)
    rows = [(k, float(rnd.randint(0, 40))) for k in ("a", "a", "a", "b") for _ in range(37)] + [("c", 7.0), ("d", None)]
    got = {r.k: (r.lo, r.mid, r.hi) for r in group_quantiles(
        spark.createDataFrame(rows, "k string, v double"), "k", "v", {"lo": 0.0, "mid": 0.5, "hi": 0.95}, discrete=True).collect()}
    for k in "abc":
        v = [x for key, x in rows if key == k]
        assert got[k] == tuple(float(np.quantile(v, p, method="inverted_cdf")) for p in (0.0, 0.5, 0.95))
    assert "d" not in got


def test_feature_cache_and_id_maps(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="kestrel-test-"), "cache")
    fio.save_feature_cache(spark, {"u": spark.createDataFrame([(1, 2.0)], "user_id long, genre_taste double"),
                                   "i": spark.createDataFrame([(1, 0)], "item_id long, genre_Drama int")}, path)
    tables, genres = fio.load_feature_cache(spark, path, ["i", "u"])
    assert genres == ["genre_Drama", "genre_taste"] and tables["u"].count() == 1
    fio.write_id_maps(spark.createDataFrame([(10, 1), (11, 1)], "raw long, idx long"), path + "/map")
    with pytest.raises(ValueError, match="idx is not unique"):
        fio.read_id_maps(spark, path + "/map", "raw", "idx")


@pytest.mark.parametrize("low, seq_low, moved", [(0, 1, 1), (1, 1, 0), (0, 0, 0), (2, 1, 0)])
def test_align_id_base(spark, low, seq_low, moved):
    x = spark.createDataFrame([(low,), (low + 3,)], "i long")
    s = spark.createDataFrame([(seq_low,)], "j long")
    assert [r.i for r in prep.align_id_base(x, s, "i", "j").orderBy("i").collect()] == [low + moved, low + 3 + moved]
    assert prep.align_id_base(x.limit(0), s, "i", "j").count() == 0


def test_genre_overlaps_join_a_user_once_and_equal_brute_force(spark):
    from kestrel.operators import ranking as rk
    c = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 10, 1), (3, 11, 1), (None, 10, 1)],
                              "user_id long, item_id long, cand_rank long")
    hist = spark.createDataFrame([(1, 10, 1, 1), (1, 11, 2, 2), (1, 11, 3, 3), (2, 11, 1, 4), (None, 10, 1, 5)],
                                 "user_id long, item_id long, ts long, tie long")
    # Item 10 has a genre twice, item 12 none; user 3 has no history.
    g = spark.createDataFrame([(10, "a"), (10, "a"), (10, "b"), (11, "b")], "item_id long, genre string")
    prefs = rk.genre_preferences(hist, g)
    out = rk.online_overlap(rk.genre_overlap(c, prefs, g), hist, g, last=2)
    primary = spark.createDataFrame([(10, 0), (11, 1)], "item_id long, primary_genre_idx long")
    out = rk.primary_genre_overlap(out, hist, primary)
    got = {(r.user_id, r.item_id): tuple(round(x, 6) for x in (
        r.genre_overlap, r.genre_max_match, r.online_overlap, r.is_same_top_genre, r.primary_genre_overlap))
        for r in out.collect()}
    assert got == {(1, 10): (1.4, 0.6, 0.333333, 1, 0.333333), (1, 11): (0.6, 0.6, 1.0, 1, 0.666667),
                   (1, 12): (0.0, 0.0, 0.0, 0, 0.0), (2, 10): (1.0, 1.0, 0.333333, 1, 0.0),
                   (3, 11): (0.0, 0.0, 0.0, 0, 0.0), (None, 10): (0.0, 0.0, 0.0, 0, 0.0)}
    # Rows of the lists are not multiplied by genres and regrouped.
    plan = rk.genre_overlap(c, prefs, g)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2
