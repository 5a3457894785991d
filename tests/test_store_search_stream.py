import datetime as dt
import difflib
import os
import tempfile

from pyspark.sql import functions as F

from kestrel.operators import feature_store as fs, search as srch, bandit as bd
from kestrel.sources import files as fio
from kestrel.streaming import io as sio, jobs as sj


def test_pit_join_vs_brute_force(spark):
    t0 = dt.datetime(2024, 1, 1)
    feats = [(1, t0 + dt.timedelta(hours=h), h) for h in (0, 5, 30, 80)] + [(2, t0 + dt.timedelta(hours=1), 7)]
    facts = [(i, u, t0 + dt.timedelta(hours=h)) for i, (u, h) in enumerate([(1, 0), (1, 4), (1, 29), (1, 31), (1, 200), (2, 0), (3, 5)])]
    f = spark.createDataFrame(feats, "user_id long, event_timestamp timestamp_ntz, v long")
    q = spark.createDataFrame(facts, "fact_id long, user_id long, ts timestamp_ntz")
    got = {r["fact_id"]: r["v"] for r in fs.pit_join(q, f, "user_id", ["v"], ttl_seconds=48 * 3600).collect()}

    def brute(u, t):
        c = [(e, v) for uu, e, v in feats if uu == u and e <= t and e >= t - dt.timedelta(hours=48)]
        return max(c)[1] if c else 0
    assert got == {i: brute(u, t) for i, u, t in facts}


def test_materialize_latest_window(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t0, 1), (1, t0 + dt.timedelta(days=2), 2), (2, t0, 3)], "k long, event_timestamp timestamp_ntz, v long")
    got = {r["k"]: r["v"] for r in fs.materialize_latest(df, "k").collect()}
    assert got == {1: 2, 2: 3}


def test_suggest_and_fuzzy_against_python(spark):
    titles = ["Toy Story (1995)", "Toy Soldiers (1991)", "Story of Us (1999)", "Heat (1995)", "The Toy (1982)", "Story Toys (2000)"]
    items = spark.createDataFrame(list(enumerate(titles)), "item_id long, title string")
    qs = spark.createDataFrame([("q1", "toy"), ("q2", "Story"), ("q3", "hheat"), ("q4", "t s")], "query_id string, query_text string")
    got = {}
    for r in srch.suggest_with_fuzzy(qs, items, limit=3).orderBy("query_id", "position").collect():
        got.setdefault(r["query_id"], []).append(r["item_id"])
    assert got["q1"][:2] == [0, 1]          # prefix matches, shorter first
    assert got["q3"] == [3]                 # fuzzy fallback: 'hheat' ~ 'heat'
    assert difflib.SequenceMatcher(None, "hheat", "heat").ratio() >= 0.65
    assert set(got["q4"]) <= {0, 1, 2, 4, 5}


def test_event_log_corrupt_and_missing(spark):
    d = tempfile.mkdtemp(prefix="kestrel-test-")
    p = os.path.join(d, "log.jsonl")
    with open(p, "w") as fh:
        fh.write('{"user_id": 1, "variant": "mf", "experiment_id": "e", "n_recs": 10, "ts": 1.0, "event_id": 1}\n\n')
        fh.write('{"user_id": 2, "variant": \n')
        fh.write('{"user_id": 3, "variant": "sasrec", "experiment_id": "e", "n_recs": 10, "ts": 2.0, "event_id": 2}\n')
    good, bad = fio.read_event_log(spark, p, fio.EXPOSURE_LOG)
    assert sorted(r["user_id"] for r in good.collect()) == [1, 3] and bad.count() == 1
    g2, b2 = fio.read_event_log(spark, os.path.join(d, "absent.jsonl"), fio.EXPOSURE_LOG)
    assert g2.count() == 0 and b2.count() == 0


def test_resolve_samples(spark):
    df = spark.createDataFrame([(1, "3, 4,5", 9)], "user_id long, sequence string, next_item long")
    r = fio.resolve_samples(df).collect()[0]
    assert r["input_seq"] == [3, 4, 5] and r["target"] == 9
    import pytest
    with pytest.raises(ValueError):
        fio.resolve_samples(df.drop("next_item"))


def test_stream_posterior_equals_batch_over_many_files(spark):
    d = tempfile.mkdtemp(prefix="kestrel-stream-")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=i), i % 7, ["view", "click", "purchase"][i % 3], 1.0, '{"k": %d}' % (i % 5))
            for i in range(60)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    for part in range(4):
        spark.createDataFrame(rows[part * 15:(part + 1) * 15], schema).write.parquet(f"{d}/part{part}")
    src = sio.dir_stream(spark, f"{d}/part*", spark.createDataFrame([], schema).schema, max_files=1)
    out = sio.run_stream(sj.posterior_updates(sj.feedback_rows(src)), "test_bandit", "update", keys=["item_id"])
    got = {r["item_id"]: (1 + r["successes"], 1 + r["failures"]) for r in out.collect()}
    batch = bd.posterior(sj.feedback_rows(spark.createDataFrame(rows, schema)))
    assert got == {r["item_id"]: (r["alpha"], r["beta"]) for r in batch.collect()}


def test_title_matches_equal_brute_force_and_move_spellings(spark):
    import random
    from kestrel.operators import search as srch
    rnd = random.Random(4)
    words = ["red", "reddish", "rod", "blue", "blu", "b", "steel", "Green"]
    names = [" ".join(rnd.sample(words, rnd.randint(1, 3))) + rnd.choice(["", " (1950)", " (1999)", "!"]) for _ in range(150)]
    rows = [(rnd.randint(1, 120), n if rnd.random() < .8 else n.upper()) for n in names] + [(500, None), (None, "red b")]
    items = spark.createDataFrame(rows, "item_id long, title string")
    texts = [(i, t) for i, t in enumerate(["red", "red b", "blu", "b", "ste", "d r", "bl re", "x", "eddi", "", None, "REDDISH rod"])]
    texts.append((0, "green"))
    queries = spark.createDataFrame(texts, "query_id long, query_text string")
    cat = {(r.item_id, r.title, r.normalized) for r in srch.normalized_catalogue(items).collect()}
    norm = {(r.item_id, r.normalized) for r in srch.normalized_catalogue(queries.select(
        srch.F.col("query_id").alias("item_id"), srch.F.col("query_text").alias("title"))).collect() if r.normalized}
    want = {}
    for qid, q in norm:
        for item, title, n in cat:
            keys = [(0, 0, 0, "")] if n == q else []
            if n.startswith(q):
                keys.append((1, -(300 - (len(n) - len(q))), len(n), title.lower()))
            elif q in n:
                keys.append((1, -(220 - n.index(q)), len(n), title.lower()))
            elif n and all(any(t.startswith(p) for t in n.split(" ")) for p in q.split(" ")):
                keys.append((1, -180, len(n), title.lower()))
            for k in keys:
                at = want.setdefault(qid, {})
                k = (*k, item is not None, item)
                at[item] = min(at.get(item, k), k)
    for limit in (1, 8):
        got = {}
        for r in sorted(srch.suggest(queries, items, limit).collect(), key=lambda r: (r.query_id, r.position)):
            got.setdefault(r.query_id, []).append((r.item_id, r.tier, r.score))
        assert got == {q: [(i, k[0], -k[1]) for i, k in sorted(v.items(), key=lambda x: x[1])][:limit] for q, v in want.items()}
    # Many items of one spelling: only the first of them are held.
    many = spark.range(5000).selectExpr("id AS item_id", "'red rod' AS title")
    _, held, whole, most = srch._forms(srch.normalized_catalogue(many), 8)
    assert (held.count(), whole.count(), most) == (8, 8, 1)
