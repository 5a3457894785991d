"""Top-k that streams items past blocks of queries; cache entries with one timer per user and batch."""

import datetime as dt
import random
from types import SimpleNamespace

import numpy as np
import pytest

from kestrel.operators import vectors as vx
from kestrel.streaming import jobs as sj
from kestrel.streaming.state import EPOCH, CacheEntries, micros


def _brute(q, items, k, seen=frozenset()):
    out = {}
    for u, x in q:
        found = sorted((-float(np.dot(x, v)), i) for i, v in items
                       if (u, i) not in seen and np.isfinite(v).all() and np.isfinite(x).all())
        out.setdefault(u, []).extend(found)
    return {u: [i for _, i in sorted(f)[:k]] for u, f in out.items() if f}


def _got(spark, q, items, k, seen=(), **more):
    vec = lambda rows, name: spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], f"{name} long, vec array<double>")
    gone = spark.createDataFrame(sorted(seen) * 2, "qid long, item_id long") if seen else None
    top = vx.topk_inner_product(vec(q, "qid"), vec(items, "item_id"), k=k, seen=gone, **more)
    got = {}
    for r in top.orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.item_id)
        assert r["rank"] == len(got[r.qid])
    return got, top


@pytest.mark.parametrize("span", [1 << 33, 100])
def test_streamed_topk_equals_brute_force(spark, monkeypatch, span):
    monkeypatch.setattr(vx, "SPAN", span)
    monkeypatch.setattr(vx, "CELLS", 64)
    r = np.random.default_rng(1)
    m = np.round(r.normal(size=(90, 4)) * 8) / 8      # exact sums, so ties are ties
    m[40:70] = m[3]                                      # one very common vector
    m[7], m[8] = [np.nan] * 4, [np.inf, 0, 0, 0]
    items = [(int(i), v) for i, v in zip(r.permutation(90), m)]
    q = [(u, np.round(r.normal(size=4) * 8) / 8) for u in range(25)]
    seen = {(int(u), int(i)) for u, i in r.integers(0, 90, (400, 2)) if u < 25} | {(0, i) for i in range(88)}
    got, _ = _got(spark, q, items, 6, seen, q_block=9, i_block=11)
    assert got == _brute(q, items, 6, seen)


@pytest.mark.parametrize("size", [1.0, 1e-20, 1e18, 1e160])
def test_scores_that_single_precision_cannot_tell_apart(spark, size):
    base = np.array([0.6, 0.8, 0.0]) * size
    items = [(i, base + np.array([0, 0, 1e-9 * size * ((7 * i) % 40)])) for i in range(40)]
    q = [(1, np.array([0.6, 0.8, 1.0])), (2, np.array([0.6, 0.8, -1.0])), (3, np.zeros(3))]
    got, _ = _got(spark, q, items, 5, i_block=8)
    assert got == _brute(q, items, 5)


def test_only_k_rows_a_query_leave_the_blocks(spark):
    # Before, every block of items sent k rows a query to a window that merged them.
    r = np.random.default_rng(2)
    items = [(i, v) for i, v in enumerate(r.normal(size=(60, 3)))]
    q = [(u, v) for u, v in enumerate(r.normal(size=(20, 3)))]
    got, top = _got(spark, q, items, 4, q_block=7, i_block=5)
    assert got == _brute(q, items, 4)
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "FlatMapCoGroups" not in plan


class _Handle:
    """List, value and timers of one key, in memory; counts the timers set."""

    def __init__(self):
        self.rows, self.value, self.timers, self.n_set = [], None, set(), 0

    def getListState(self, name, schema):
        return SimpleNamespace(appendList=self.rows.extend, get=lambda: iter(list(self.rows)),
                               put=lambda some: self.rows.__setitem__(slice(None), some), clear=self.rows.clear)

    def getValueState(self, name, schema):
        return SimpleNamespace(get=lambda: self.value, exists=lambda: self.value is not None,
                               update=lambda v: setattr(self, "value", v), clear=lambda: setattr(self, "value", None))

    def registerTimer(self, ms):
        self.n_set += 1
        self.timers.add(ms)


def _entries(rows, ttl):
    out, written, hits = [], None, 0
    for us, _, served in sorted(rows) + [(10 ** 18, 0, None)]:
        if written is not None and us >= written + ttl:
            out.append((written, written + ttl, "expired", hits))
            written = None
        if served and written is None:
            written, hits = us, 0
        elif served:
            hits += 1
        elif served is False and written is not None:
            out.append((written, us, "invalidated", hits))
            written = None
    return out


@pytest.mark.parametrize("seed", range(30))
def test_cache_entries_need_few_timers(seed):
    # Before, every moment of a row and every entry set a timer, and each walked all rows waiting.
    rnd = random.Random(seed)
    rows = [(rnd.randrange(3_000) * 1_000_000 + rnd.randrange(3), i, rnd.random() < 0.6) for i in range(120)]
    handle, machine, got, calls, mark = _Handle(), CacheEntries(300), [], 0, 0
    machine.init(handle)
    batches = [[] for _ in range(4)]
    for r in rows:      # no row comes behind the watermark of its batch
        batches[min(3, r[0] // 1_000_000_000 + rnd.randrange(2))].append(r)
    for n, batch in enumerate([*batches, []]):
        seen = [SimpleNamespace(ts=EPOCH + dt.timedelta(microseconds=us), event_id=i, served=s) for us, i, s in batch]
        rnd.shuffle(seen)
        machine.handleInputRows((1,), iter(seen), None)
        mark = [0, 0, 1_000_000, 2_000_000, 10 ** 9][n]
        for ms in sorted(t for t in handle.timers if t <= mark):
            handle.timers.discard(ms)
            calls += 1
            got += machine.handleExpiredTimer((1,), SimpleNamespace(getCurrentWatermarkInMs=lambda: mark), None)
    while handle.timers:
        handle.timers.clear()
        got += machine.handleExpiredTimer((1,), SimpleNamespace(getCurrentWatermarkInMs=lambda: 10 ** 12), None)
    assert [(micros(r.written_at), micros(r.ended_at), r.reason, r.hits) for r in got] == _entries(rows, 300_000_000)
    assert handle.n_set <= 12 and calls <= 12


def test_other_events_move_the_watermark_but_reach_no_state(spark, tmp_path):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    stream = spark.readStream.schema(schema).parquet(str(tmp_path))
    df = sj.cache_entries(stream)._jdf
    plan = spark._jsparkSession.sessionState().optimizer().execute(df.queryExecution().analyzed()).toString()
    state, mark = plan.index("TransformWithState"), plan.index("EventTimeWatermark")
    assert state < plan.index("Filter") < mark and "Filter" not in plan[mark:]
