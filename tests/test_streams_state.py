"""Streams with keyed state: several micro-batches, late rows, and state that leaves."""

import datetime as dt

from kestrel.operators import monitoring as mon
from kestrel.sources import adapters as A
from kestrel.streaming import io as sio
from kestrel.streaming import jobs as sj
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def events(spark, rows):
    """rows: (seconds, user, type)."""
    return spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s), u, kind, 1.0, '{"k": %d}' % (i % 5))
                                  for i, (s, u, kind) in enumerate(rows)], EVENTS)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_cache_entries_live_from_the_last_write(spark):
    ev = events(spark, [
        (0, 1, "view"), (200, 1, "view"), (299, 1, "view"), (300, 1, "view"),     # hits, then expired, then rewritten
        (310, 1, "click"), (311, 1, "click"), (320, 1, "view"),                   # dropped once, written again
        (250, 2, "view"), (540, 2, "purchase"), (549, 2, "view"), (851, 2, "view"),   # straddles two fixed windows
        (5, 3, "click"), (6, 3, "signup"), (9000, 4, "view"), (9000.5, 4, "error")])
    out = sio.run_replay(spark, ev, "t-cache", sj.cache_entries, timers=True)
    got = sorted((r.user_id, r.written_at, r.ended_at, r.reason, r.hits) for r in out.collect())
    assert got == [
        (1, at(0), at(300), "expired", 2), (1, at(300), at(310), "invalidated", 0), (1, at(320), at(620), "expired", 0),
        (2, at(250), at(540), "invalidated", 0), (2, at(549), at(849), "expired", 0), (2, at(851), at(1151), "expired", 0),
        (4, at(9000), at(9300), "expired", 0)]


def test_alerts_on_a_stream_equal_the_islands(spark):
    rows = [(60 * m, m % 3, "error" if 20 <= m < 42 or m in (70, 71) else "view") for m in range(0, 120) if not 47 <= m < 64]
    ev = events(spark, rows)
    states = sio.run_replay(spark, ev, "t-alerts", sj.alert_states, slices=4, timers=True).collect()
    req = ev.select("ts", F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
                    (A.event_item() < 50).alias("cached"))
    w = mon.alert_windows(req)
    want = mon.sustained(w, "high_error", 2).unionByName(mon.sustained(w, "low_cache", 2)).unionByName(
        mon.sustained(w, "no_traffic", 1)).collect()
    naive = lambda t: t.replace(tzinfo=None)
    resolved = sorted((r.alert, r.start, r.end, r.n_windows, r.fired) for r in states if r.state == "resolved")
    assert resolved == sorted((r.alert, naive(r.start), naive(r.end), r.n_windows, r.fired) for r in want)
    assert {r.alert for r in states} == {"high_error", "no_traffic"}
    firing = {(r.alert, r.start) for r in states if r.state == "firing"}
    assert firing == {(a, s) for a, s, _, _, fired in resolved if fired}
    assert sum(r.state == "pending" for r in states) == len(resolved)


def test_attribution_keeps_conversions_without_exposure(spark):
    ev = events(spark, [(0, 1, "view"), (100, 1, "view"), (200, 1, "click"), (3801, 1, "click"), (50, 2, "click"),
                        (60, 2, "view"), (9000, 3, "view"), (12600, 3, "click"), (20_000, 4, "error")])

    def job(s):
        views = s.where(F.col("event_type").isin("view", sio.CLOSING)).withColumn("variant", F.col("user_id").cast("string"))
        clicks = s.where(F.col("event_type").isin("click", sio.CLOSING)).withColumn("variant", F.lit(None).cast("string"))
        return sj.attribute_last(views, clicks)
    progress = []
    out = sio.run_replay(spark, ev, "t-x9", job, progress=progress).where("conversion_id IS NOT NULL")
    got = sorted((r.conversion_id, r.exposure_id, r.variant) for r in out.collect())
    assert got == [(2, 1, "1"), (3, None, "unknown"), (4, None, "unknown"), (7, 6, "3")]
    assert len([p for p in progress if p.numInputRows]) >= 3


def test_sessions_leave_the_state_when_they_close(spark):
    ev = events(spark, [(3 * 3600 * s + 60 * i, u, "view") for s in range(6) for i in range(4) for u in range(5)])
    progress = []
    out = sio.run_replay(spark, ev, "t-sessions", lambda s: sj.sessions(s).select("user_id", "s", "n_events"), slices=6,
                         progress=progress).where(F.col("user_id") >= 0)
    got = out.collect()
    assert len(got) == 30 and {r.n_events for r in got} == {4}
    rows = [sum(o.numRowsTotal for o in p.stateOperators) for p in progress]
    assert rows[-1] <= 2 and max(rows) < 30


def test_replay_of_an_empty_table(spark):
    none = spark.createDataFrame([], EVENTS)
    assert sio.run_replay(spark, none, "t-empty", sj.cache_entries, timers=True).count() == 0
