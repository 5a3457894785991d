import math

from pyspark.sql import functions as F

from kestrel.operators import evaluation, vectors as vx


def test_bundle_self_test(spark):
    ranks = spark.createDataFrame([(i, r) for i, r in enumerate([1, 3, 5, 7, 12, 2, 4, 50, 9, 100])], "user_id long, rank long")
    rows = {r["k"]: r for r in evaluation.metric_bundle(ranks, ks=(10,)).collect()}
    assert rows[10]["hr"] == 0.7
    expect_ndcg = sum(1 / math.log2(r + 1) for r in [1, 3, 5, 7, 2, 4, 9]) / 10
    assert abs(rows[10]["ndcg"] - round(expect_ndcg, 6)) < 1e-9
    assert rows[10]["n_users"] == 10


def test_empty_ranks_give_no_rows(spark):
    ranks = spark.createDataFrame([], "user_id long, rank long")
    assert evaluation.metric_bundle(ranks).count() == 0


def test_rank_self_test(spark):
    scores = [0.0, 0.9, 0.1, 0.95, 0.7, 0.3, 0.6, 0.5]
    items = spark.createDataFrame([(i, [s]) for i, s in enumerate(scores)], "item_id long, vec array<double>")
    q = spark.createDataFrame([(1, [1.0], 3), (2, [1.0], 1)], "qid long, vec array<double>, target_id long")
    pos = {r["qid"]: r["position"] for r in vx.target_position(q, items, q_block=1, i_block=3).collect()}
    assert pos == {1: 1, 2: 2}
    masked = vx.target_position_masked(q.where("qid = 2"), items, spark.createDataFrame([(2, 3)], "qid long, item_id long"))
    assert masked.collect()[0]["position"] == 1
