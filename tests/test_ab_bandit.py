import math

import pytest
from pyspark.sql import functions as F

from kestrel.functions.scalar import two_sided_p
from kestrel.operators import experiment as ab, bandit as bd
from kestrel.sources.adapters import experiments


def _assign(spark, users, exp="retrieval_v1", cfg=None):
    req = spark.createDataFrame([(u, exp) for u in users], "user_id long, experiment_id string")
    return ab.assign_variant(req, cfg if cfg is not None else experiments(spark))


def test_assignment_known_bucket_and_determinism(spark):
    a = _assign(spark, [42, 42]).collect()
    assert a[0]["variant"] == a[1]["variant"] == "mf"  # md5('42:retrieval_v1') bucket 0.1088 < 0.5


def test_split_is_balanced(spark):
    dist = {r["variant"]: r["n_users"] for r in ab.variant_distribution(_assign(spark, range(10000))).collect()}
    assert abs(dist["mf"] / 10000 - 0.5) < 0.02


def test_unknown_experiment_raises(spark):
    with pytest.raises(Exception):
        _assign(spark, [1], exp="nope").collect()


def test_inactive_gives_control_and_bad_config_flagged(spark):
    cfg = spark.createDataFrame([("x", ["a", "b"], [0.5, 0.5], False), ("bad", ["a"], [0.7, 0.3], True)],
                                "experiment_id string, variants array<string>, traffic_split array<double>, is_active boolean")
    assert {r["variant"] for r in _assign(spark, range(50), "x", cfg).collect()} == {"a"}
    checks = {r["experiment_id"]: r["valid"] for r in ab.check_config(cfg).collect()}
    assert checks == {"x": True, "bad": False}


def _stats(spark, n_a, k_a, n_b, k_b):
    df = spark.createDataFrame([("retrieval_v1", "mf", n_a, k_a), ("retrieval_v1", "sasrec", n_b, k_b)],
                               "experiment_id string, variant string, exposures long, conversions long")
    return ab.with_ctr(df)


def test_z_test_significance(spark):
    cfg = experiments(spark)
    same = ab.z_test(_stats(spark, 1000, 100, 1000, 100), cfg).collect()[0]
    assert not same["is_significant"] and same["p_value"] == pytest.approx(1.0, abs=1e-6)
    diff = ab.z_test(_stats(spark, 1000, 50, 1000, 150), cfg).collect()[0]
    assert diff["is_significant"] and diff["decision"] == "deploy_treatment"
    p = diff["p_value"]
    assert abs(p - math.erfc(abs(diff["z"]) / math.sqrt(2))) < 1e-12


@pytest.mark.parametrize("z", [0.0, 1e-6, 0.5, 1.96, 2.8, 2.9, 5.5, 8.0, -10.0, 30.0])
def test_normal_tail_relative_error(spark, z):
    p = spark.range(1).select(two_sided_p(F.lit(z)).alias("p")).collect()[0]["p"]
    assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-12)


def test_ci_brackets_ctr_and_caps(spark):
    s = _stats(spark, 10, 12, 0, 3).collect()
    for r in s:
        assert r["ci_low"] <= r["ctr"] <= r["ci_high"]
    capped = [r for r in s if r["variant"] == "mf"][0]
    assert capped["effective_conversions"] == 10 and capped["ctr"] == 1.0


def test_bandit_posterior_merge_and_validation(spark):
    fb = spark.createDataFrame([(1, 1.0), (1, 0.0), (1, 1.0), (2, 0.0), (3, 0.5)], "item_id long, reward double")
    post = {r["item_id"]: (r["alpha"], r["beta"]) for r in bd.posterior(fb).collect()}
    assert post == {1: (3.0, 2.0), 2: (1.0, 2.0)}  # reward 0.5 is quarantined
    _, bad = bd.valid_rewards(fb)
    assert bad.count() == 1
    rows = [(1, 1.0), (1, 0.0), (1, 1.0), (2, 0.0), (3, 0.5)]
    first = bd.posterior(spark.createDataFrame(rows[:2], "item_id long, reward double"))
    second = spark.createDataFrame(rows[2:], "item_id long, reward double")
    merged = {r["item_id"]: (r["alpha"], r["beta"]) for r in bd.merge(first, second).collect()}
    assert merged[1] == (3.0, 2.0) and merged[2] == (1.0, 2.0)


def test_rerank_is_a_deterministic_permutation(spark):
    c = spark.createDataFrame([(1, i, float(i)) for i in range(20)], "user_id long, item_id long, score double")
    arms = spark.createDataFrame([(i, 1.0 + i, 1.0) for i in range(10)], "item_id long, alpha double, beta double")
    a = bd.rerank(c, arms, seed=5).orderBy("item_id").collect()
    b = bd.rerank(c, arms, seed=5).orderBy("item_id").collect()
    assert sorted(r["new_rank"] for r in a) == list(range(1, 21))
    assert [r["draw"] for r in a] == [r["draw"] for r in b]


def test_thompson_win_rate(spark):
    c = spark.createDataFrame([(u, i) for u in range(400) for i in (0, 1)], "user_id long, item_id long")
    arms = spark.createDataFrame([(0, 80.0, 20.0), (1, 20.0, 80.0)], "item_id long, alpha double, beta double")
    d = bd.thompson_sample(c, arms, seed=1).groupBy("user_id").agg(F.max_by("item_id", "draw").alias("w"))
    wins = d.where("w = 0").count() / 400
    assert wins > 0.95
