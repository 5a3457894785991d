"""Edge cases of the reference's operators."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from kestrel.operators import governance, prep, quality, ranking
from kestrel.session import ensure_checkpoint_dir


def test_constant_feature_has_no_drift(spark):
    e = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    got = {r.feature: r for r in quality.drift(e, e.withColumn("a", F.col("a") + 1), ["a", "b"]).collect()}
    assert got["b"].psi == 0 and got["b"].mean_diff == 0 and got["b"].status == "ok"
    assert got["a"].psi > 0


def test_promotion_needs_the_gate(spark):
    runs = spark.createDataFrame([("r1", "new", 0.3), ("r2", "new", 0.9), ("r3", "old", 0.801), ("r4", "old", 0.9),
                                  ("r5", "old", None)], "run_id string, model string, ndcg_10 double")
    prod = spark.createDataFrame([("old", 0.8)], "model string, ndcg_10 double")
    got = {r.run_id: r.status for r in governance.promotion(runs, prod).collect()}
    assert got == {"r1": "quality_gate_failed", "r2": "promoted", "r3": "not_improved", "r4": "promoted", "r5": "failed"}


def test_dataset_stats_of_nothing(spark):
    r = prep.dataset_stats(spark.createDataFrame([], "user_id bigint, item_id bigint")).first()
    assert r.n_users == 0 and r.sparsity is None and r.avg_per_user is None


def test_serving_names(spark):
    df = spark.createDataFrame([(1.0, 3.0, 7.0, 8.0)], "user_avg_rating double, item_rating_count_log double, "
                               "user_last_timestamp double, x_item_first_timestamp double")
    out = prep.drop_leaky(prep.rename_serving_to_training(df))
    assert out.columns == ["u_user_avg_rating", "item_rating_count_log", "i_item_rating_count"]
    assert out.first().i_item_rating_count == pytest.approx(19.085537)


def test_positive_replaces_the_last_of_a_short_list(spark):
    c = spark.createDataFrame([(1, 1, 10, 0.9), (1, 2, 11, 0.5), (2, 1, 12, 0.4)],
                              "user_id bigint, cand_rank bigint, item_id bigint, score double")
    t = spark.createDataFrame([(1, 99), (2, 12), (3, 98)], "user_id bigint, item_id bigint")
    got = sorted((r.user_id, r.cand_rank, r.item_id) for r in ranking.inject_positive(c, t).collect())
    assert got == [(1, 1, 10), (1, 2, 99), (2, 1, 12), (3, 1, 98)]


def test_k_core_limit_raises(spark):
    # A chain that loses one link per pass.
    rows = [(u, i) for u in range(6) for i in (u, u + 1)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint")
    assert prep.k_core(df, 2, 2).count() == 0
    with pytest.raises(RuntimeError):
        prep.k_core(df, 2, 2, max_iter=1)


def test_cluster_without_shared_folder_raises():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077",
                              getConf=lambda: SimpleNamespace(get=lambda k, d=None: d))
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(session)
