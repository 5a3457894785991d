"""Blocks of queries take turns where the copies of the items would be too many (als_recommend)."""

import os

import pytest
from pyspark.sql import functions as F

from kestrel import session
from kestrel.operators import vectors as vx


@pytest.mark.parametrize("with_seen", [False, True])
def test_rounds_give_the_same_ranks(spark, monkeypatch, with_seen):
    vec = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(7)).cast("float"))
    q = spark.range(60).select(F.when(F.col("id") < 59, F.col("id")).alias("qid"), vec.alias("vec"))
    items = spark.range(100, 180).select(F.col("id").alias("item_id"), vec.alias("vec"))
    seen = spark.range(300).select((F.col("id") % 60).alias("qid"), (F.col("id") * 7 % 80 + 100).alias("item_id"))

    def ranked(copies):
        monkeypatch.setattr(vx, "COPIES", copies)
        written, real = [], vx.cut_lineage
        monkeypatch.setattr(vx, "cut_lineage", lambda df: written.append(1) or real(df))
        df = vx.topk_inner_product(q, items, k=5, q_block=11, seen=seen if with_seen else None)
        out = sorted((tuple(r) for r in df.collect()), key=str)
        monkeypatch.setattr(vx, "cut_lineage", real)
        return len(written), out

    once, few, single = ranked(1 << 25), ranked(160), ranked(1)
    assert (once[0], few[0], single[0]) == (0, 3, 6)
    assert once[1] == few[1] == single[1] and len(once[1]) == 300


def test_shuffle_files_go_with_the_query_that_made_them(spark, tmp_path):
    def files():
        top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in top for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    before = files()
    out = session.cut_lineage(spark.range(1000).repartition(5))
    assert not files() - before
    assert out.count() == 1000
    assert spark.conf.get(session._CLEANUP, "false") == "false"
