"""The shared steps of the candidate lists: each moves its rows once."""

import numpy as np

from kestrel.operators import ranking as rk, vectors as vx

LISTS = "user_id long, cand_rank long, item_id long, score double"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_products_in_tiles_reach_the_same_cells(monkeypatch):
    r = np.random.default_rng(3)
    q, m = r.integers(-3, 4, (13, 5)).astype(np.float32), r.integers(-3, 4, (5, 41)).astype(np.float32)
    bound = r.integers(-2, 6, 13).astype(np.float32)
    for across in (1024, 16, 7):    # a whole tile, tiles of whole eights but the last, odd tiles
        monkeypatch.setattr(vx, "ACROSS", across)
        row, col = vx._reached(q, m, bound)
        want = np.nonzero(q @ m >= bound[:, None])
        assert (np.diff(row) >= 0).all()
        assert sorted(zip(row.tolist(), col.tolist())) == list(zip(want[0].tolist(), want[1].tolist()))


def test_masked_and_unusable_items_stay_out_of_later_chunks(spark, monkeypatch):
    monkeypatch.setattr(vx, "ACROSS", 16)
    monkeypatch.setattr(vx, "TILE", 4)
    r = np.random.default_rng(4)
    m = np.round(r.normal(size=(300, 4)) * 8) / 8
    m[200:230], m[250] = m[3], [np.nan] * 4
    q = np.round(r.normal(size=(21, 4)) * 8) / 8
    seen = {(int(u), int(i)) for u, i in zip(r.integers(0, 21, 900), r.integers(0, 300, 900))}
    vec = lambda x, name: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"{name} long, vec array<double>")
    top = vx.topk_inner_product(vec(q, "qid"), vec(m, "item_id"), k=5, i_block=40,
                                seen=spark.createDataFrame(sorted(seen), "qid long, item_id long"))
    got = {}
    for x in top.orderBy("qid", "rank").collect():
        got.setdefault(x.qid, []).append(x.item_id)
    for u in range(21):
        s = sorted((-float(q[u] @ m[i]), i) for i in range(300) if i != 250 and (u, i) not in seen)
        assert got[u] == [i for _, i in s[:5]]


def test_blocks_fill_whole_rounds_of_cores():
    # Before, 7 blocks ran on 8 cores, and 33 on 12 left most of the last round idle.
    assert vx._whole_rounds(7, 90_000, 8) == 8
    assert vx._whole_rounds(33, 540_000, 12) == 36
    assert vx._whole_rounds(1, 100, 8) == 1 and vx._whole_rounds(1, 1_500, 8) == 3


def test_pooled_vectors_by_blocks_of_users(spark, monkeypatch):
    monkeypatch.setattr(vx, "PIECE", 32)
    monkeypatch.setattr(vx, "NARROW", 40)
    r = np.random.default_rng(5)
    m = r.normal(size=(30, 3))
    items = [(i, [float(c) for c in v]) for i, v in enumerate(m)] + [(4, [1.0, 2.0, 3.0]), (40, None), (None, [1.0, 1.0, 1.0])]
    rows = [(int(u) if u < 60 else None, int(i) if i < 45 else None, float(w)) for u, i, w in
            zip(r.integers(0, 63, 900), r.integers(0, 48, 900), r.integers(-1, 4, 900))]
    hist = spark.createDataFrame(rows, "user_id long, item_id long, w double")
    pooled = vx.pool_history(hist, spark.createDataFrame(items, "item_id long, vec array<double>"), weight="w")
    assert "SortMergeJoin" not in _plan(pooled) and "Summarizer" not in _plan(pooled)
    got = {x.user_id: x.vec for x in pooled.collect()}
    want = {}
    for u, i, w in rows:
        for at, v in items:
            if w > 0 and i is not None and at == i and v is not None:
                want[u] = want.get(u, 0.0) + w * np.array(v)
    assert set(got) == set(want) and None in got
    for u, v in want.items():
        assert np.allclose(got[u], v / np.linalg.norm(v))


def test_pooled_vectors_of_named_users(spark):
    hist = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "who string, item_id long")
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "item_id long, vec array<float>")
    got = {x.who: [round(c, 6) for c in x.vec] for x in vx.pool_history(hist, items, user="who").collect()}
    assert got == {"a": [0.707107, 0.707107], "b": [1.0, 0.0]}


def test_injection_reads_the_list_for_its_places_once(spark):
    c = spark.createDataFrame([(1, 1, 5, .5), (1, 2, 6, .4), (2, 1, 7, .3), (None, 1, 8, .1), (3, 4, 9, .2), (5, 1, 1, .3),
                               (5, 2, 2, .2), (5, 2, 3, .2)], LISTS)
    t = spark.createDataFrame([(1, 6), (2, 9), (4, 3), (None, 2), (3, None), (3, 8), (5, 4)], "user_id long, item_id long")
    out = rk.inject_positive(c, t)
    got = sorted(((x.user_id, x.cand_rank, x.item_id, round(x.score, 6)) for x in out.collect()), key=str)
    assert got == sorted([(1, 1, 5, .5), (1, 2, 6, .4), (2, 1, 9, .299999), (None, 1, 8, .1), (3, 4, None, .199999),
                          (3, 4, 8, .199999), (4, 1, 3, 0.0), (None, 1, 2, 0.0), (5, 1, 1, .3), (5, 2, 4, .199999)], key=str)
    # Before, the list met its targets by item, its worst places by rank, and was aggregated per user: four reads.
    assert _plan(out).count("LogicalRDD") + _plan(out).count("LocalRelation") <= 4


def test_padding_reads_the_list_once(spark):
    c = spark.createDataFrame([(1, 1, 5, .5, "x"), (1, 2, 6, .4, "y"), (None, 1, 8, .1, "z"), (3, 4, 9, .2, "v")], LISTS + ", more string")
    out = rk.pad_lists(c, 3)
    got = sorted((tuple(x) for x in out.collect()), key=str)
    assert got == sorted([(1, 1, 5, .5, "x"), (1, 2, 6, .4, "y"), (1, 3, 0, 0.0, None), (None, 1, 8, .1, "z"),
                          (None, 2, 0, 0.0, None), (None, 3, 0, 0.0, None), (3, 4, 9, .2, "v")], key=str)
    assert "Union" not in _plan(out) and out.dtypes == c.dtypes


def test_overlap_ranks_each_list_once(spark):
    a = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, 7), (None, 1, 5)], "user_id long, rank long, item_id long")
    b = spark.createDataFrame([(1, 1, 6), (1, 3, 5), (3, 1, 7), (None, 1, 5)], "user_id long, rank long, item_id long")
    out = rk.overlap_at_k(a, b, 2)
    assert sorted((tuple(x) for x in out.collect()), key=str) == sorted(
        [(1, 1, .5), (2, 0, 0.0), (3, 0, 0.0), (None, 0, 0.0)], key=str)
    assert "Union" not in _plan(out) and out.dtypes[1] == ("overlap", "bigint")
