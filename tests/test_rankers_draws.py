"""Pairwise gradients and the group-wise ranker, Beta draws, vector blocks with masked pairs."""

import math
import random

import numpy as np

from kestrel.operators import bandit, ranker, vectors
from kestrel.operators.ranking import group_metrics


def _plain_gradients(rows):
    """rows (item, label, score) of one user -> {item: (gradient, weight)} by all pairs."""
    place = {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])), 1)}
    gain = {r[0]: 2.0 ** r[1] - 1 for r in rows}
    ideal = sum(g / math.log2(n + 1) for n, g in enumerate(sorted(gain.values(), reverse=True), 1))
    out = {r[0]: [0.0, 0.0] for r in rows}
    for a in rows:
        for b in rows:
            if a[1] > b[1]:
                swap = abs((gain[a[0]] - gain[b[0]]) * (1 / math.log2(place[a[0]] + 1) - 1 / math.log2(place[b[0]] + 1))) / ideal
                rho = 1 / (1 + math.exp(a[2] - b[2]))
                for item, sign in ((a[0], 1), (b[0], -1)):
                    out[item][0] += sign * rho * swap
                    out[item][1] += rho * (1 - rho) * swap
    return out


def test_pair_gradients_against_all_pairs(spark):
    rnd = random.Random(3)
    rows = [(u, i, rnd.choice([0, 0, 1, 2]) if u else 0, rnd.choice([0.0, 0.5, rnd.random()])) for u in range(5) for i in range(12)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, label int, s double")
    got = {(r.user_id, r.item_id): (r.gradient, r.weight) for r in ranker.pair_gradients(df, "s").collect()}
    assert len(got) == len(rows)
    for u in range(5):
        for item, want in _plain_gradients([r[1:] for r in rows if r[0] == u]).items():
            assert np.allclose(got[u, item], want)     # user 0 has one label only: all 0


def test_lambda_ranker_beats_its_baseline_on_other_users(spark):
    rnd = random.Random(4)
    rows = []
    for u in range(120):
        hit = rnd.randrange(10)
        for i in range(10):
            x = rnd.random() + (0.7 if i == hit else 0.0)
            rows.append((u, i, int(i == hit), x, rnd.random(), rnd.random()))
    m = spark.createDataFrame(rows, "user_id long, item_id long, label int, x double, noise double, rank_norm double")
    train, test = m.where("user_id < 90"), m.where("user_id >= 90")
    model = ranker.fit_lambda(train, ["x", "noise"], rounds=4)
    own = group_metrics(model.score(test), "rank_score", ks=(10,)).first().ndcg_10
    base = group_metrics(test, "rank_norm", ks=(10,)).first().ndcg_10
    assert 1 <= len(model.trees) <= 4 and own > base + 0.1
    flat = ranker.fit_lambda(train.where("label = 0"), ["x", "noise"], rounds=2)
    assert flat.trees == [] and flat.score(test).where("rank_score <> 0").count() == 0


def test_beta_draws_follow_their_distribution():
    rng = np.random.default_rng(0)
    seed = rng.integers(-2 ** 63, 2 ** 63 - 1, 60000)
    for a, b in ((1.0, 1.0), (3.0, 7.0), (0.4, 0.8), (250.0, 12.0)):
        got = bandit.beta_draws(np.full(60000, a), np.full(60000, b), seed)
        qs = np.linspace(0.02, 0.98, 17)
        assert np.abs(np.quantile(got, qs) - np.quantile(rng.beta(a, b, 60000), qs)).max() < 0.015
        cut = rng.permutation(60000)[:500]     # a row's draw does not depend on its batch
        assert (bandit.beta_draws(np.full(500, a), np.full(500, b), seed[cut]) == got[cut]).all()


def test_topk_masks_seen_pairs_in_blocks(spark):
    rng = np.random.default_rng(7)
    iv, qv = rng.integers(-2, 3, (40, 4)).astype(float), rng.integers(-2, 3, (9, 4)).astype(float)
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(iv)], "item_id long, vec array<double>")
    queries = spark.createDataFrame([(q, v.tolist()) for q, v in enumerate(qv)], "qid long, vec array<double>")
    seen = [(q, i) for q in range(8) for i in range(40) if (q + i) % 3 == 0] + [(7, i) for i in range(38)] + [(1, 99), (1, 2), (1, 2)]
    gone = spark.createDataFrame(seen, "qid long, item_id long")
    for block in (1000, 7):
        got = {}
        for r in vectors.topk_inner_product(queries, items, k=5, q_block=block, i_block=block, seen=gone).orderBy("qid", "rank").collect():
            got.setdefault(r.qid, []).append(r.item_id)
        for q in range(9):
            left = [i for i in range(40) if (q, i) not in set(seen)]
            assert got.get(q, []) == sorted(left, key=lambda i: (-(qv[q] @ iv[i]), i))[:5]
