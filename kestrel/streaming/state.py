"""Keyed state machines with event-time timers (``transformWithState``).

Rows of one key may come in any order within the watermark's lateness.  A machine whose
result depends on order keeps them in state until the watermark has passed them, and
walks them in event time when a timer says so; what it emits therefore does not depend
on how the stream was cut into micro-batches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EPOCH = dt.datetime(1970, 1, 1)


def micros(t: dt.datetime) -> int:
    return (t.replace(tzinfo=None) - EPOCH) // dt.timedelta(microseconds=1)


def moment(us: int) -> dt.datetime:
    return EPOCH + dt.timedelta(microseconds=us)


class CacheEntries(StatefulProcessor):
    """The cached list of one user.

    A served list that finds no live entry writes one, which lives ``ttl`` from that write;
    one that finds it is a hit and does not prolong it.  Feedback drops a live entry.
    State: the rows ahead of the watermark, at most one entry, and as timers the earliest moment
    at which something of it can be final, one a micro-batch at most.
    """

    OUTPUT = "user_id bigint, written_at timestamp_ntz, ended_at timestamp_ntz, reason string, hits bigint"

    def __init__(self, ttl_seconds: int):
        self.ttl = ttl_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ahead = handle.getListState("ahead", "us bigint, event_id bigint, served boolean")
        self.entry = handle.getValueState("entry", "written bigint, hits bigint")

    def handleInputRows(self, key, rows, timerValues):
        some = [(micros(r.ts), r.event_id, r.served) for r in rows if r.served is not None]
        if some:
            self.ahead.appendList(some)
            # All rows that the watermark has passed are walked at once, so the first one's timer will do.
            self.handle.registerTimer(-(-min(us for us, _, _ in some) // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # All that the watermark has passed is final, whichever timer came first.
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.ahead.get())
        now = [r for r in waiting if r[0] <= upto]
        rest = waiting[len(now):]
        if now:
            self.ahead.put(rest) if rest else self.ahead.clear()
        entry = self.entry.get()
        written, hits = (entry[0], entry[1]) if entry else (None, 0)
        out = []

        def end(at, reason):
            out.append(Row(user_id=key[0], written_at=moment(written), ended_at=moment(at), reason=reason, hits=hits))

        for us, _, served in now:
            if written is not None and us >= written + self.ttl:
                end(written + self.ttl, "expired")
                written = None
            if served and written is None:
                written, hits = us, 0
            elif served:
                hits += 1
            elif written is not None:
                end(us, "invalidated")
                written = None
        if written is not None and written + self.ttl <= upto:
            end(written + self.ttl, "expired")
            written = None
        if written is not None:
            self.entry.update((written, hits))
        elif entry:
            self.entry.clear()
        # Ends of the entry and rows ahead come later than the watermark.
        later = [r[0] for r in rest[:1]] + [written + self.ttl for _ in range(written is not None)]
        if later:
            self.handle.registerTimer(-(-min(later) // 1000))
        return iter(out)

    def close(self) -> None:
        pass


class AlertStates(StatefulProcessor):
    """O16 on a stream: inactive, pending, firing, for one alert.

    Input: closed windows in any order within a micro-batch.  A window in which the
    condition holds makes the alert pending; after ``needed`` windows in a row it fires; the
    first window without it resolves the alert.  A timer at the end of the next window
    notices that it never came: an empty window, in which only ``absent`` alerts hold.
    Emitted: one row per transition.  State: one row.
    """

    OUTPUT = "alert string, state string, start timestamp_ntz, end timestamp_ntz, n_windows bigint, fired boolean"

    def __init__(self, width_seconds: int, needed: dict, absent: tuple):
        self.width, self.needed, self.absent = width_seconds * 1_000_000, needed, absent

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "last bigint, start bigint, n bigint")

    def handleInputRows(self, key, rows, timerValues):
        last, start, n = self.state.get() if self.state.exists() else (None, None, 0)
        out = []
        for us, holds, closing in sorted((micros(r.window_start), r.holds, r.closing) for r in rows):
            while last is not None and last + self.width < us and not closing:
                last, start, n = self._step(key[0], last + self.width, key[0] in self.absent, start, n, out)
            if closing:
                self._resolve(key[0], last, start, n, out)
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.state.clear()
                return iter(out)
            last, start, n = self._step(key[0], us, holds, start, n, out)
        self._keep(last, start, n)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        out = []
        if self.state.exists():
            last, start, n = self.state.get()
            # The window after `last` ended without a row; an older timer has been overtaken.
            if expiredTimerInfo.getExpiryTimeInMs() * 1000 >= last + 2 * self.width:
                last, start, n = self._step(key[0], last + self.width, key[0] in self.absent, start, n, out)
                self._keep(last, start, n)
        return iter(out)

    def _keep(self, last, start, n):
        if last is not None:
            self.state.update((last, start, n))
            self.handle.registerTimer((last + 2 * self.width) // 1000)

    def _step(self, alert, us, holds, start, n, out):
        if holds:
            start, n = (us, 1) if start is None else (start, n + 1)
            if n == 1:
                out.append(self._row(alert, "pending", us, us, 1))
            if n == self.needed[alert]:
                out.append(self._row(alert, "firing", start, us, n))
        else:
            self._resolve(alert, us - self.width, start, n, out)
            start, n = None, 0
        return us, start, n

    def _resolve(self, alert, last, start, n, out):
        if start is not None:
            out.append(self._row(alert, "resolved", start, last, n))

    def _row(self, alert, state, start, end, n):
        return Row(alert=alert, state=state, start=moment(start), end=moment(end), n_windows=n,
                   fired=n >= self.needed[alert])

    def close(self) -> None:
        pass
