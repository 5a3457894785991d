"""Operator 11: periodic runs of words by enumeration of maximal pairs.

A run with period q that spans the words [s, e) is the maximal pair (s, s + q):
its two suffixes agree on e - s - q words, differ after them, and differ before
them.  So the suffixes of a text are sorted, the tree of their LCP intervals is
built bottom-up, and where two children of an interval meet, the positions of the
smaller one look for partners in the larger one: closer than a third of the
common length, which says that the run has four periods, and of another left
word, which the interval's lists of positions by left word tell.  The pairs found
are the runs; nothing is extended afterwards.

Only suffixes whose first five words recur near enough can lie in a run, so only
their surroundings are sorted.  Everything happens inside one text, so there is no
shuffle; a task works through its texts in slices of a few MB.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.store import columns
from kestrel.llm.text import fmix, hashes, pieces, spans, utf8

SHORTEST = 6      # words of a run
PERIODS = 4       # times its period
_PREFIX = 5       # least common length of a pair: max(6 - q, 3 q) over all q
_FACTORS = fmix(np.arange(1, _PREFIX + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
WORD = r"[^\x20\x09-\x0D]+"


def _lengths(mask: np.ndarray) -> np.ndarray:
    """For every true entry the length of its stretch of true entries (0 elsewhere)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    out = np.zeros(len(mask), np.int64)
    size = edge[1::2] - edge[::2]
    out[mask] = np.repeat(size, size)
    return out


def _recurring(word: np.ndarray, doc: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Mask of the positions whose first five words may start inside a run.

    ``left``: words from the position to its text's end.  In a run of period q all
    five-word windows recur at distance q, and they are at least 3 q - 4 in a row; so
    a window whose nearest copy is farther than that allows is in no run."""
    n = len(word) - _PREFIX + 1
    mask = np.zeros(len(word), bool)
    if n < 2:
        return mask
    window = fmix(doc[:n].astype(np.uint64) + np.uint64(1))
    for k in range(_PREFIX):
        window = window + word[k:n + k] * _FACTORS[k]
    at = np.flatnonzero(left[:n] >= _PREFIX)
    window = window[at]
    order = np.argsort(window)
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at, window = at[twice], window[twice]
    order = np.lexsort((at, window))
    at, window = at[order], window[order]
    gap = np.diff(at)
    gap[window[1:] != window[:-1]] = len(word) * 4
    far = np.full(1, len(word) * 4)
    near = np.full(len(word), len(word) * 4)
    near[at] = np.minimum(np.concatenate([far, gap]), np.concatenate([gap, far]))
    mask[at] = True
    while True:
        fits = mask & (3 * near <= _lengths(mask) + 4)
        if (fits == mask).all():
            return mask
        mask = fits


def _suffixes(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, LCP with the suffix before) by prefix doubling.

    Equal words have equal numbers; every stretch ends with a number of its own."""
    names = [np.unique(word, return_inverse=True)[1].astype(np.int64)]
    n = len(word)
    while names[-1].max() < n - 1:
        now, step = names[-1], 1 << (len(names) - 1)
        after = np.zeros(n, np.int64)
        after[:n - step] = now[step:] + 1
        names.append(np.unique(now * (n + 1) + after, return_inverse=True)[1].astype(np.int64))
    order = np.empty(n, np.int64)
    order[names[-1]] = np.arange(n)
    a, b = order[:-1], order[1:]
    common = np.zeros(max(n - 1, 0), np.int64)
    for j in range(len(names) - 1, -1, -1):
        # Stretches end with unique numbers, so equal blocks never reach past the end.
        common += np.where(names[j][a + common] == names[j][b + common], 1 << j, 0)
    return order, np.concatenate([[0], common])


class Interval:
    """Positions of an LCP interval: all in order, and by the word to their left."""

    __slots__ = ("all", "by_left")

    def __init__(self, at: int, left: int):
        self.all, self.by_left = [at], {left: [at]}

    def others(self, lo: int, hi: int, left: int) -> list[int]:
        """Positions in [lo, hi] whose left word is not ``left``.

        Halves of the range in which that class holds every position are left out, so
        the cost follows what is found."""
        every, own = self.all, self.by_left.get(left)
        i, j = bisect_left(every, lo), bisect_right(every, hi)
        if own is None:
            return every[i:j]
        out, todo = [], [(i, j)]
        while todo:
            i, j = todo.pop()
            if i >= j:
                continue
            alike = bisect_right(own, every[j - 1]) - bisect_left(own, every[i])
            if alike == j - i:
                continue
            if not alike:
                out += every[i:j]
            else:
                mid = (i + j) // 2
                todo += [(i, mid), (mid, j)]
        return out

    def take(self, other: "Interval") -> None:
        _merge(self.all, other.all)
        for left, some in other.by_left.items():
            own = self.by_left.get(left)
            if own is None:
                self.by_left[left] = some
            else:
                _merge(own, some)


def _merge(into: list[int], some: list[int]) -> None:
    if len(some) < 8:
        for x in some:
            insort(into, x)
    else:
        into += some
        into.sort()  # two sorted runs: linear


def _meet(a: Interval, b: Interval, common: int, found: dict) -> Interval:
    """Maximal pairs between two children of an interval of ``common`` words, then their union."""
    if len(a.all) < len(b.all):
        a, b = b, a
    reach = common // (PERIODS - 1)
    for left, some in b.by_left.items():
        for x in some:
            for y in a.others(x - reach, x + reach, left):
                q = abs(x - y)
                if q + common >= SHORTEST:
                    key = (min(x, y), q + common)
                    found[key] = min(q, found.get(key, q))
    a.take(b)
    return a


def _intervals(at: list[int], left: list[int], common: list[int], found: dict) -> None:
    """Bottom-up over one stretch of suffixes that share five words; ``common[i]`` belongs
    to i - 1 and i.  ``found`` gets {(start, length): smallest period}."""
    open_, node = [], Interval(at[0], left[0])
    for i in range(1, len(at) + 1):
        depth = common[i] if i < len(at) else 0
        while open_ and open_[-1][0] > depth:
            inner, before = open_.pop()
            node = _meet(before, node, inner, found)
        if i == len(at):
            return
        if open_ and open_[-1][0] == depth:
            node = _meet(open_.pop()[1], node, depth, found)
        open_.append((depth, node))
        node = Interval(at[i], left[i])


def find_runs(word: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int, int]]:
    """``word``: numbers of the words of several texts one after another, ``doc``: their text.
    (text, start, length, period) of every run, sorted; starts count from the text's first word."""
    n = len(word)
    new = np.ones(n + 1, bool)
    new[1:-1] = doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    to_end = np.repeat(first[1:], np.diff(first)) - np.arange(n) if n else np.empty(0, np.int64)
    mask = _recurring(word, doc, to_end)
    if not mask.any():
        return []
    # A window's five words and the one after them.
    at = np.flatnonzero(mask)
    cover = np.bincount(at, minlength=n + 1) - np.bincount(at + np.minimum(_PREFIX + 1, to_end[at]), minlength=n + 1)
    inside = np.flatnonzero(np.cumsum(cover)[:n] > 0)
    ends = np.ones(len(inside), bool)
    ends[:-1] = (np.diff(inside) > 1) | (doc[inside[1:]] != doc[inside[:-1]])
    # Words are told apart by text; each stretch is closed by a number of its own.
    _, number = np.unique(word[inside] ^ fmix(doc[inside].astype(np.uint64) + np.uint64(1)), return_inverse=True)
    place = np.arange(len(inside)) + np.concatenate([[0], np.cumsum(ends)[:-1]])
    total = len(inside) + int(ends.sum())
    stretch = number.max() + 1 + np.arange(total)
    stretch[place] = number
    origin = np.full(total, -1)
    origin[place] = inside
    order, common = _suffixes(stretch)
    deep = common >= _PREFIX
    edge = np.flatnonzero(np.diff(np.concatenate([[0], deep.view(np.int8), [0]])))
    found: dict = {}
    before = np.where(new[:n], -1, np.concatenate([[0], np.unique(word, return_inverse=True)[1][:-1]])) \
        if n else np.empty(0, np.int64)
    for lo, hi in zip(edge[::2], edge[1::2]):
        spot = origin[order[lo - 1:hi]]
        depth = common[lo - 1:hi]
        ranked = np.sort(spot)
        if (PERIODS - 1) * int(np.diff(ranked).min()) <= int(depth[1:].max()):
            _intervals(spot.tolist(), before[spot].tolist(), depth.tolist(), found)
    base = np.concatenate([first[:-1], [0]])
    return sorted((int(doc[s]), int(s - base[np.searchsorted(first, s, side="right") - 1]), length, q)
                  for (s, length), q in found.items())


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_words, runs array<(start, length, period)>, collapsed.

    Words are split at white space and compared byte for byte (64-bit hashes within one
    text).  A run is a stretch of at least 6 words and 4 periods that no neighbouring
    word extends; runs are sorted by start, then period.  ``collapsed``: the words that
    no run holds after its first period, joined by one space.  Null, empty and blank
    texts have no words, no runs and an empty ``collapsed``.  One output row per input
    row, repeated rows and null ids included; extra columns are ignored.
    """
    own = docs.select(*columns(docs, "doc_id", "text"))
    schema = (f"doc_id {own.schema['doc_id'].dataType.simpleString()}, n_words bigint, "
              "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                data, offsets = utf8(part["text"])
                starts, ends = spans(data, offsets)
                count = np.diff(np.searchsorted(starts, offsets))
                doc = np.repeat(np.arange(len(part)), count)
                runs: list[list[dict]] = [[] for _ in range(len(part))]
                for d, s, length, q in find_runs(hashes(data, starts, ends, lower=False), doc):
                    runs[d].append({"start": s, "length": length, "period": q})
                collapsed = []
                for d in range(len(part)):
                    words = data[offsets[d]:offsets[d + 1]].tobytes().split()
                    if runs[d]:
                        drop = np.zeros(len(words) + 1, np.int64)
                        for r in runs[d]:
                            drop[r["start"] + r["period"]] += 1
                            drop[r["start"] + r["length"]] -= 1
                        words = compress(words, (np.cumsum(drop)[:-1] == 0).tolist())
                    collapsed.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(count), pa.array(runs, kind),
                     pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
    return own.mapInArrow(run, schema)


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with a periodic tail in about every tenth text.

    With h = crc32 of the decimal doc_id and g = h div 10: if h mod 10 is 0, the words from
    a = g mod n on repeat with period 1 + (n - a) div (3 + g mod 8).  A null doc_id plants nothing."""
    own = docs.select(*columns(docs, "doc_id", "text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # The words are bound as a lambda's variable, so that they are cut out of the text once.
    tailed = F.expr(rf"""
        transform(array(regexp_extract_all(text, r'{WORD}', 0)), w -> transform(
          array(named_struct('a', _g % size(w), 'p', 1 + (size(w) - _g % size(w)) div (3 + _g % 8))), s ->
          array_join(transform(sequence(0L, size(w) - 1L),
                               i -> get(w, CAST(IF(i < s.a, i, s.a + (i - s.a) % s.p) AS INT))), ' '))[0])[0]""")
    planted = F.col("_h").isNotNull() & (F.col("_h") % 10 == 0) & F.col("text").rlike(WORD)
    return (own.withColumn("_h", h).withColumn("_g", F.expr("_h div 10"))
            .select("doc_id", F.when(planted, tailed).otherwise(F.col("text")).alias("text")))


def runs_query(docs: DataFrame) -> DataFrame:
    """The longest run (ties: smallest start, then period) and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return (periodic_runs(with_planted_tails(docs)).withColumn("_best", best)
            .select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("_best.s")).alias("start"),
                    F.col("_best.length").alias("length"), (-F.col("_best.p")).alias("period"),
                    F.expr("1000 * _best.length div -_best.p").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
