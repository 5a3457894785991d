"""Vector retrieval.

Exact top-k is a blocked nested-loop join: queries are hashed into blocks of at
most ~``BLOCK`` rows, and every block is one partition in which its queries come
first and all items follow in id order.  A task keeps the best k items of its
queries while the items pass in chunks: products in single precision rule out what
cannot count, the rest is scored in doubles.  Items a query must not get travel
just before the item and are masked there.  A query's ranks are final in its
task, so only k rows a query leave it, and its memory follows the block, not the items.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.plans.ordering import _num_partitions
from kestrel.plans.topk import top_k
from kestrel.session import cut_lineage


# ---- V1 / V6 / V12 ------------------------------------------------------------------

def l2_normalize(df: DataFrame, vec: str = "vec", eps: float = 1e-8) -> DataFrame:
    norm = F.sqrt(F.aggregate(F.col(vec), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return df.withColumn(vec, F.transform(F.col(vec), lambda x: (x.cast("double") / F.greatest(norm, F.lit(eps)))))


def scrub(df: DataFrame, vec: str = "vec") -> DataFrame:
    """Non-finite entries -> 0, then re-normalise; ``n_fixed`` = number of entries replaced."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    fixed = df.withColumn("n_fixed", F.size(F.filter(F.col(vec), bad)).cast("bigint")).withColumn(
        vec, F.transform(F.col(vec), lambda x: F.when(bad(x), F.lit(0.0)).otherwise(x.cast("double"))))
    return l2_normalize(fixed, vec)


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, v: acc + v)


def pair_scores(pairs: DataFrame, users: DataFrame, items: DataFrame, user: str = "user_id",
                item: str = "item_id", vec: str = "vec") -> DataFrame:
    """score = <u, v> for given (user, item) pairs (two equi-joins, no product)."""
    u = users.select(user, F.col(vec).alias("_u"))
    i = items.select(item, F.col(vec).alias("_i"))
    return pairs.join(u, user).join(i, item).withColumn("score", dot(F.col("_u"), F.col("_i"))).drop("_u", "_i")


# ---- blocked scoring -------------------------------------------------------------------------

def _blocks(n: int, size: int) -> int:
    return max(1, int(math.ceil(n / float(size))))


def _replicated(df: DataFrame, key: str, own: str, other: str, n_own: int, n_other: int) -> DataFrame:
    return (df.withColumn(own, F.pmod(F.xxhash64(F.col(key)), F.lit(n_own)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))))


SLICE = 512      # query rows scored at once inside a block of target positions
BLOCK = 16384    # rows of a block of target positions; most queries of a task of the top-k
CHUNK = 4096     # items of the top-k scored at once
PIECE = 1 << 16  # cells scored in doubles at once
TILE = 512       # rows of a tile of products in single precision, small enough for the processor's caches
ACROSS = 1024    # its columns
COPIES = 1 << 25  # item rows that the blocks of one round of the top-k are sent
SPAN = 1 << 33   # scores of a task of the top-k from which few queries share the items among tasks
WIDE = 32768     # most rows of a block of the top-k: a pair of blocks ships about 16 MB of 64 floats
NARROW = 2048    # fewest, however many tasks there are
CELLS = 1 << 19  # scores of a block held at once


def _block_sizes(n_q: int, n_i: int, tasks: int) -> tuple[int, int]:
    """Rows of a query block and of an item block.

    Every query row travels once per item block and every item row once per query block, so
    blocks are as large as ``WIDE`` allows with two pairs a task.  Few items make one block: a
    query then meets all of them in one place.
    """
    side = min(WIDE, max(NARROW, int(math.sqrt(n_q * n_i / (2.0 * tasks)))))
    if n_i > BLOCK:
        return side, side
    return min(WIDE, max(NARROW, n_i // 4, -(-n_q // (2 * tasks)))), max(1, n_i)


def _whole_rounds(blocks: int, n: int, cores: int) -> int:
    """At least ``blocks``, as many as keep all cores busy to the end, but none below a fourth of ``NARROW`` rows."""
    return max(blocks, min(cores * _blocks(blocks, cores), _blocks(n, NARROW // 4)))


def _matrix(column) -> np.ndarray:
    """The vectors of an Arrow column as rows of doubles."""
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _ids(column) -> np.ndarray:
    # A null id is carried as the least long.
    return column.fill_null(-2 ** 63).to_numpy().astype(np.int64)


def _best_cells(s: np.ndarray, want: int, slack: float | np.ndarray = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of at least the ``want`` highest cells of every row, and all equal to them
    or less than the row's ``slack`` below.

    The cells fall into groups; the want-th highest of the groups' maxima is reached by at
    least ``want`` cells, so only cells from there on can count.
    """
    n = s.shape[1]
    deep = min(64, n // (2 * want))
    if deep > 1:
        m = n // deep
        tops = s[:, :m].copy()
        for g in range(1, deep):
            np.maximum(tops, s[:, g * m:(g + 1) * m], out=tops)
    else:
        tops = s
    at = tops.shape[1] - want
    least = np.partition(tops, at, axis=1)[:, at] - slack
    return np.nonzero((s >= least[:, None]) & (s > -np.inf))


def _topk_block(k: int, exclude_self: bool, ranked: bool = False):
    """Function of two Arrow tables, queries (qid, vec[, seen]) and items (item_id, vec): the best
    ``k`` items a query row, or (``ranked``) a query id with their ranks."""
    def fn(q: pa.Table, i: pa.Table) -> pa.Table:
        names = ["qid", "rank", "item_id", "score"] if ranked else ["qid", "item_id", "score"]
        if not q.num_rows or not i.num_rows:
            return pa.table({n: pa.array([], pa.float64() if n == "score" else pa.int64()) for n in names})
        ids = _ids(i["item_id"])
        order = np.argsort(ids, kind="stable")   # equal scores: smaller id first
        ids, m = ids[order], np.ascontiguousarray(_matrix(i["vec"])[order].T)
        qids_all, vecs = _ids(q["qid"]), _matrix(q["vec"])
        masked = q["seen"].combine_chunks() if "seen" in q.column_names else None
        want = min(k, len(ids))
        out = []
        rows = max(16, CELLS // len(ids))
        for lo in range(0, len(qids_all), rows):
            qids = qids_all[lo:lo + rows]
            s = vecs[lo:lo + rows] @ m
            s[~np.isfinite(s)] = -np.inf
            if exclude_self:
                s[qids[:, None] == ids[None, :]] = -np.inf
            if masked is not None:
                lists = masked.slice(lo, rows)
                row = np.repeat(np.arange(len(qids)), lists.value_lengths().fill_null(0).to_numpy())
                if len(row):
                    gone = lists.flatten().to_numpy().astype(np.int64)
                    # An id may stand several times among the items, or not at all.
                    first, last = np.searchsorted(ids, gone, "left"), np.searchsorted(ids, gone, "right")
                    while len(gone):
                        hit = first < last
                        row, first, last, gone = row[hit], first[hit], last[hit], gone[hit]
                        s[row, first] = -np.inf
                        first = first + 1
            row, col = _best_cells(s, want)
            score = s[row, col]
            order = np.lexsort((col, -score, row))
            row, col, score = row[order], col[order], score[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            best = place < want
            out.append((qids[row[best]], ids[col[best]], score[best], place[best] + 1))
        qid, item, score, place = (np.concatenate(x) for x in zip(*out))
        if not ranked:
            return pa.table([qid, item, score], names=names)
        if len(np.unique(qids_all)) < len(qids_all):
            order = np.lexsort((item, -score, qid))
            qid, item, score = qid[order], item[order], score[order]
            place = np.arange(len(qid)) - np.searchsorted(qid, qid) + 1
            best = place <= k
            qid, item, score, place = qid[best], item[best], score[best], place[best]
        return pa.table([qid, place, item, score], names=names)
    return fn


def _matches(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in ``wanted``, position in the sorted ``ids``) of all equal pairs."""
    first, last = np.searchsorted(ids, wanted, "left"), np.searchsorted(ids, wanted, "right")
    n = last - first
    of = np.repeat(np.arange(len(wanted)), n)
    return of, first[of] + np.arange(len(of)) - (np.cumsum(n) - n)[of]


def _reached(q: np.ndarray, mt: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column), by row, of the products of ``q`` and ``mt`` that are not below the row's bound, in
    tiles; in double precision a product that is not a number or infinite is left out later."""
    rows, cols = [], []
    for at in range(0, mt.shape[1], ACROSS):
        s = q @ mt[:, at:at + ACROSS]
        hit = (s >= bound[:, None]).ravel()
        if len(hit) % 8:
            cell = np.flatnonzero(hit)
        else:   # few cells count: eight are looked at together, then those of the eights found
            of = np.flatnonzero(hit.view(np.uint64))
            eight, place = np.nonzero(hit.reshape(-1, 8)[of])
            cell = of[eight] * 8 + place
        row, col = np.divmod(cell, s.shape[1])
        rows.append(row)
        cols.append(col + at)
    row, col = np.concatenate(rows), np.concatenate(cols)
    order = np.argsort(row, kind="stable")
    return row[order], col[order]


def _lengths(m: np.ndarray) -> np.ndarray:
    """Euclidean norms of the rows, also where the squares would overflow."""
    most = np.abs(m).max(axis=1, initial=0.0)
    most = np.where(most > 0, most, 1.0)
    scaled = m / most[:, None]
    return most * np.sqrt(np.einsum("ij,ij->i", scaled, scaled))


class _Best:
    """The best ``k`` items of a block of queries, while the items pass in id order."""

    def __init__(self, k: int, exclude_self: bool, chunk: int):
        self.k, self.exclude_self, self.chunk = k, exclude_self, chunk
        self.asked, self.waiting, self.n_waiting, self.q = [], [], 0, None
        self.seen = np.empty(0, np.int64), np.empty(0, np.int64)   # item, query id

    def add(self, t: pa.Table) -> None:
        kind = t["kind"].to_numpy()
        if (kind == 0).any():
            part = t.filter(pa.array(kind == 0))
            self.asked.append((_ids(part["id"]), _matrix(part["qvec"])))
        if (kind == 1).any():
            part = t.filter(pa.array(kind == 1))
            users = part["users"].combine_chunks()
            item = np.repeat(_ids(part["id"]), users.value_lengths().to_numpy())
            self.seen = np.concatenate([self.seen[0], item]), np.concatenate([self.seen[1], _ids(users.flatten())])
        if (kind == 2).any():
            part = t.filter(pa.array(kind == 2))
            self.waiting.append((_ids(part["id"]), _matrix(part["ivec"])))
            self.n_waiting += part.num_rows
            if self.n_waiting >= self.chunk:
                self._drain(self.chunk)

    def _start(self) -> None:
        ids, q = (np.concatenate(x) for x in zip(*self.asked)) if self.asked else (np.empty(0, np.int64), np.empty((0, 0)))
        usable = np.isfinite(q).all(axis=1)
        order = np.argsort(ids[usable], kind="stable")
        self.asked, self.ids, self.q = [], ids[usable][order], q[usable][order]
        self.norm = _lengths(self.q)
        # Products of this size neither overflow nor vanish in single precision.
        self.small = self.norm.max(initial=0.0) < 1e15
        self.q32 = self.q.astype(np.float32) if self.small else None
        self.least = np.full(len(self.ids), -np.inf)               # the k-th best so far
        self.kept = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)   # row, item, score
        self.held, self.n_held = [], 0

    def _drain(self, least: int) -> None:
        if self.q is None:
            self._start()
        if not self.waiting:
            return
        ids, m = (np.concatenate(x) for x in zip(*self.waiting))
        lo = 0
        while len(ids) - lo >= max(least, 1):
            self._score(ids[lo:lo + self.chunk], m[lo:lo + self.chunk])
            lo += self.chunk
        self.waiting = [(ids[lo:], m[lo:])] if lo < len(ids) else []
        self.n_waiting = max(0, len(ids) - lo)

    def _masked(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, column), by row, of what must not be returned; drops pairs of items that have passed."""
        item, who = self.seen
        if self.exclude_self:
            own = np.unique(self.ids)
            item, who = np.concatenate([item, own]), np.concatenate([who, own])
        of, col = _matches(ids, item)
        again, row = _matches(self.ids, who[of])
        row, col = row, col[again]
        # An id may come again at the start of the next chunk.
        ahead = self.seen[0] >= ids[-1]
        self.seen = self.seen[0][ahead], self.seen[1][ahead]
        order = np.argsort(row, kind="stable")
        return row[order], col[order]

    def _score(self, ids: np.ndarray, m: np.ndarray) -> None:
        if not len(self.ids):
            return
        masked_row, masked_col = self._masked(ids)
        usable = np.isfinite(m).all(axis=1)
        longest = _lengths(m[usable]).max(initial=0.0)
        single = self.small and longest < 1e15
        kind = np.float32 if single else np.float64
        q, mt = (self.q32 if single else self.q), np.ascontiguousarray(np.where(usable[:, None], m, 0.0).T, dtype=kind)
        # The most by which a product may differ from the sum in doubles.
        slack = float(np.finfo(kind).eps) * (m.shape[1] + 8) * self.norm * longest + 1e-27
        want, step = min(self.k, len(ids)), max(16, min(TILE, CELLS // len(ids)))
        for lo in range(0, len(q), step):
            a, b = np.searchsorted(masked_row, [lo, lo + step])
            least, off = self.least[lo:lo + step], slack[lo:lo + step]
            if np.isinf(least).any():
                s = q[lo:lo + step] @ mt
                if not single:
                    s[~np.isfinite(s)] = -np.inf
                s[:, ~usable] = -np.inf
                s[masked_row[a:b] - lo, masked_col[a:b]] = -np.inf
                row, col = _best_cells(s, want, 2.0 * off)
            else:
                # Rounded down: a bound must not rise on its way to single precision.
                bound = np.nextafter((least - off).astype(kind), kind(-np.inf))
                row, col = _reached(q[lo:lo + step], mt, bound)
                if b > a or not usable.all():
                    gone = np.isin(row * len(ids) + col, (masked_row[a:b] - lo) * len(ids) + masked_col[a:b])
                    keep = usable[col] & ~gone
                    row, col = row[keep], col[keep]
            row = row + lo
            for at in range(0, len(row), PIECE):
                r, c = row[at:at + PIECE], col[at:at + PIECE]
                score = np.einsum("ij,ij->i", self.q[r], m[c])
                # Later items have larger ids: an equal score does not displace.
                new = np.isfinite(score) & (score > self.least[r])
                self.held.append((r[new], ids[c[new]], score[new]))
                self.n_held += int(new.sum())
            if self.n_held > max(len(self.kept[0]), 2 * CELLS):
                self._merge()

    def _merge(self) -> None:
        row, item, score = (np.concatenate(x) for x in zip(self.kept, *self.held))
        # Both sorts are stable: what came first has the smaller id. Small integers are sorted by digits.
        order = np.argsort(-score, kind="stable")
        order = order[np.argsort(row[order].astype(np.min_scalar_type(len(self.ids))), kind="stable")]
        row, item, score = row[order], item[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best, last = place < self.k, place == self.k - 1
        self.least[row[last]] = score[last]
        self.kept, self.held, self.n_held = (row[best], item[best], score[best]), [], 0

    def result(self):
        self._drain(1)
        self._merge()
        row, item, score = self.kept
        qid = self.ids[row]
        if len(np.unique(self.ids)) < len(self.ids):
            order = np.lexsort((item, -score, qid))
            qid, item, score = qid[order], item[order], score[order]
        rank = np.arange(len(qid)) - np.searchsorted(qid, qid) + 1
        best = rank <= self.k
        out = pa.table([qid[best], rank[best], item[best], score[best]], names=["qid", "rank", "item_id", "score"])
        yield from out.to_batches(max_chunksize=PIECE)


def _best_of_blocks(k: int, exclude_self: bool, chunk: int):
    """Arrow function of sorted partitions: block by block its queries, then items and who has seen them."""
    def fn(batches):
        at, best = None, None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            block = t["_b"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo and block[lo] != at:
                    if best is not None:
                        yield from best.result()
                    at, best = block[lo], _Best(k, exclude_self, chunk)
                if hi > lo:
                    best.add(t.slice(lo, hi - lo))
        if best is not None:
            yield from best.result()
    return fn


def topk_inner_product(queries: DataFrame, items: DataFrame, k: int = 100, q_block: int | None = None,
                       i_block: int | None = None, exclude_self: bool = False, seen: DataFrame | None = None,
                       qid: str = "qid", item: str = "item_id", vec: str = "vec") -> DataFrame:
    """Exact inner-product top-k: (qid, rank, item_id, score), rank 1..k by score desc, item asc.

    ``seen`` (qid, item) are pairs that must not be returned; they travel in front of their item, as
    one list per block of queries.  Scores that are not finite do not count.  ``q_block`` queries
    share a task, ``i_block`` items are scored at once.  Only few queries over very many items share
    the items among tasks, whose results are then merged.  Items travel once per block of queries;
    where that is more than ``COPIES`` rows, blocks take turns: a round's result is written, and its
    shuffle files go before the next begins.
    """
    n_q, n_i, tasks = queries.count(), items.count(), _num_partitions(queries, None)
    rows = q_block or min(BLOCK, _block_sizes(n_q, n_i, tasks)[0])
    nqb = _blocks(n_q, rows)
    if not q_block:
        nqb = _whole_rounds(nqb, n_q, queries.sparkSession.sparkContext.defaultParallelism)
    turns = max(1, COPIES // max(n_i, 1))
    if turns < nqb:
        if not q_block:     # large blocks: fewer copies in all
            nqb = max(_blocks(n_q, 4 * BLOCK), turns)
        cores = queries.sparkSession.sparkContext.defaultParallelism
        spans = _blocks(cores, turns)
    else:
        spans = max(1, min(tasks // nqb, _blocks(min(rows, n_q) * n_i, SPAN)))
    none = lambda t: F.lit(None).cast(t)
    q_type, i_type = queries.schema[vec].dataType, items.schema[vec].dataType

    def step(df, kind, qvec, ivec, users):
        return df.select("_b", F.lit(kind).alias("kind"), "id", qvec.alias("qvec"), ivec.alias("ivec"), users.alias("users"))

    own = F.pmod(F.xxhash64("qid"), F.lit(nqb)).cast("int") * spans
    span = F.pmod(F.xxhash64("id"), F.lit(spans)).cast("int")
    every = lambda lo, hi, by: F.explode(F.sequence(F.lit(lo * by), F.lit((hi - 1) * by), F.lit(by)))
    fn = _best_of_blocks(k, exclude_self, i_block or CHUNK)

    def ranked_of(lo, hi):
        """Best items of the queries in the blocks from ``lo`` to before ``hi``."""
        mine = (F.col("_o") >= lo * spans) & (F.col("_o") < hi * spans)
        q = (queries.where(F.col(vec).isNotNull()).select(F.col(qid).cast("bigint").alias("qid"), F.col(vec).alias("v"))
             .select(F.col("qid").alias("id"), "v", own.alias("_o")).where(mine).select("*", every(0, spans, 1).alias("_s"))
             .withColumn("_b", F.col("_o") + F.col("_s")))
        i = (items.where(F.col(vec).isNotNull()).select(F.col(item).cast("bigint").alias("id"), F.col(vec).alias("v"))
             .select("id", "v", span.alias("_s"), every(lo, hi, spans).alias("_o")).withColumn("_b", F.col("_o") + F.col("_s")))
        rows_of = step(q, 0, F.col("v"), none(i_type), none("array<bigint>")).unionByName(
            step(i, 2, none(q_type), F.col("v"), none("array<bigint>")))
        if seen is not None:
            pairs = (seen.select(F.col(qid).cast("bigint").alias("qid"), F.col(item).cast("bigint").alias("id"))
                     .where("qid IS NOT NULL AND id IS NOT NULL").select("*", own.alias("_o")).where(mine)
                     .select("qid", "id", (F.col("_o") + span).alias("_b")).distinct()
                     .groupBy("_b", "id").agg(F.collect_list("qid").alias("users")))
            rows_of = rows_of.unionByName(step(pairs, 1, none(q_type), none(i_type), F.col("users")))
        sorted_rows = (rows_of.repartitionById((hi - lo) * spans, F.col("_b") - lo * spans)
                       .sortWithinPartitions("_b", F.col("kind") > 0, "id", "kind"))
        ranked = sorted_rows.mapInArrow(lambda b: fn(b), "qid long, rank long, item_id long, score double")
        if spans > 1:
            ranked = top_k(ranked.drop("rank"), ["qid"], [F.col("score").desc(), F.col("item_id").asc()], k)
        return ranked.select("qid", "rank", "item_id", "score")

    if turns < nqb:
        parts = [cut_lineage(ranked_of(lo, min(lo + turns, nqb))) for lo in range(0, nqb, turns)]
        ranked = reduce(DataFrame.unionByName, parts)
    else:
        ranked = ranked_of(0, nqb)
    return ranked.select(F.col("qid").alias(qid), "rank", F.col("item_id").alias(item), "score")


def _count_block(ties: str):
    def fn(qdf: pd.DataFrame, idf: pd.DataFrame) -> pd.DataFrame:
        if qdf.empty:
            return pd.DataFrame({"qid": [], "n_before": []})
        q = np.stack(qdf["vec"].to_numpy()).astype(np.float64)
        t = qdf["target_score"].to_numpy(dtype=np.float64)
        tid = qdf["target_id"].to_numpy(dtype=np.int64)
        if idf.empty:
            return pd.DataFrame({"qid": qdf["qid"].to_numpy(dtype=np.int64), "n_before": np.zeros(len(qdf), np.int64)})
        m = np.stack(idf["vec"].to_numpy()).astype(np.float64)
        ids = idf["item_id"].to_numpy(dtype=np.int64)
        counts = np.zeros(len(qdf), dtype=np.int64)
        for lo in range(0, len(qdf), SLICE):
            s = q[lo:lo + SLICE] @ m.T
            tt, ti = t[lo:lo + SLICE, None], tid[lo:lo + SLICE, None]
            before = s >= tt if ties == "pessimistic" else s > tt
            if ties == "id":
                before |= (s == tt) & (ids[None, :] < ti)
            before &= ids[None, :] != ti  # the target never precedes itself
            counts[lo:lo + SLICE] = before.sum(axis=1)
        return pd.DataFrame({"qid": qdf["qid"].to_numpy(dtype=np.int64), "n_before": counts})
    return fn


def target_position(queries: DataFrame, items: DataFrame, q_block: int = BLOCK, i_block: int = BLOCK,
                    qid: str = "qid", item: str = "item_id", vec: str = "vec", ties: str = "id") -> DataFrame:
    """Position of each query's target item in the full ranking by score, without sorting.

    ``ties``: items with the target's score stand before it if their id is smaller ("id"),
    never ("optimistic") or always ("pessimistic").

    ``queries`` has (qid, vec, target_id).  Each (query block, item block) group emits one
    counter per query; the counters are summed.
    """
    items_v = items.select(F.col(item).alias("target_id"), F.col(vec).alias("_tv"))
    qt = (queries.select(F.col(qid).alias("qid"), F.col(vec).alias("vec"), "target_id")
          .join(items_v, "target_id").withColumn("target_score", dot(F.col("vec"), F.col("_tv"))).drop("_tv"))
    n_q = qt.count()
    n_i = items.count()
    nqb, nib = _blocks(n_q, q_block), _blocks(n_i, i_block)
    q = _replicated(qt, "qid", "_qb", "_ib", nqb, nib)
    i = _replicated(items.select(F.col(item).alias("item_id"), F.col(vec).alias("vec")), "item_id", "_ib", "_qb",
                    nib, nqb)
    fn = _count_block(ties)
    counts = (q.groupBy("_qb", "_ib").cogroup(i.groupBy("_qb", "_ib"))
              .applyInPandas(lambda a, b: fn(a.drop(columns=["_qb", "_ib"]), b.drop(columns=["_qb", "_ib"])),
                             "qid long, n_before long"))
    return (counts.groupBy("qid").agg((F.sum("n_before") + 1).alias("position"))
            .join(qt.select("qid", "target_id"), "qid").withColumnRenamed("qid", qid))


def similar_items(items: DataFrame, k: int = 10, item: str = "item_id", vec: str = "vec") -> DataFrame:
    """V4: for every item, the k most similar other items (its own id excluded)."""
    q = items.select(F.col(item).alias("seed_id"), F.col(vec))
    return topk_inner_product(q, items, k=k, exclude_self=True, qid="seed_id", item=item, vec=vec)


def topk_excluding(queries: DataFrame, items: DataFrame, seen: DataFrame, k: int = 10,
                   qid: str = "user_id", item: str = "item_id", vec: str = "vec") -> DataFrame:
    """V5 exact mode: top-k among items the query has not seen; seen pairs are masked inside the blocks."""
    return topk_inner_product(queries, items, k=k, seen=seen, qid=qid, item=item, vec=vec)


# ---- V7 / V8 / V9 / V13 ---------------------------------------------------------------------------

def norm_stats(df: DataFrame, vec: str = "vec") -> DataFrame:
    n = F.sqrt(F.aggregate(F.col(vec), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return df.select(n.alias("_n")).agg(F.count(F.lit(1)).alias("n_vectors"), F.min("_n").alias("norm_min"),
                                        F.max("_n").alias("norm_max"), F.avg("_n").alias("norm_mean"))


def _dense(vec: str):
    return array_to_vector(F.col(vec).cast("array<double>"))


def collapse(df: DataFrame, vec: str = "vec", key: str = "qid") -> DataFrame:
    """Mean off-diagonal inner product over all pairs, via (|sum v|^2 - sum |v|^2) / (n (n - 1)).

    One aggregate of vectors with partial sums: O(rows) work, no pairs.  > 0.9 warns.
    """
    agg = df.where(F.col(vec).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.sum(_dense(vec))).alias("s"),
        F.sum(dot(F.col(vec), F.col(vec))).alias("sum_sq"))
    n = F.col("n")
    mean = F.when(n > 1, (dot(F.col("s"), F.col("s")) - F.col("sum_sq")) / (n * (n - 1)))
    return agg.select(n.alias("n_vectors"), mean.alias("mean_pair_similarity"),
                      F.coalesce(mean > 0.9, F.lit(False)).alias("collapsed"))


def pool_history(history: DataFrame, items: DataFrame, user: str = "user_id", item: str = "item_id",
                 vec: str = "vec", weight: str | None = None) -> DataFrame:
    """V9 (re-aimed): user vector = (weighted) mean of the item vectors in the user's history, L2-normalised.

    Users are dealt to blocks of at most ~``BLOCK``.  An item's vector travels once per block whose
    users have it, with the list of those users, so vectors are shipped per block and not per user; a
    task adds them up for the users of its block.  Rows without a vector, and weights that are null or
    not positive, add nothing.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    pairs = (history.select(F.col(user).alias("u"), F.col(item).alias("i"), w.alias("w")).where("w > 0 AND i IS NOT NULL")
             .groupBy("u", "i").agg(F.sum("w").alias("w")))
    n = history.select(user).distinct().count()
    blocks = _whole_rounds(_blocks(n, BLOCK), n, history.sparkSession.sparkContext.defaultParallelism)
    lists = (pairs.groupBy(F.pmod(F.xxhash64("u"), F.lit(blocks)).cast("int").alias("_b"), "i")
             .agg(F.collect_list(F.struct("u", "w")).alias("_l")))
    known = items.where(F.col(vec).isNotNull()).select(F.col(item).alias("i"), F.col(vec).alias("v"))
    shipped = (lists.join(known, "i").select("_b", "v", F.col("_l.u").alias("u"), F.col("_l.w").alias("w"))
               .repartitionById(blocks, F.col("_b")))
    kind = history.schema[user].dataType
    pooled = shipped.select("v", "u", "w").mapInArrow(
        _mean_vectors, T.StructType([T.StructField(user, kind), T.StructField(vec, T.ArrayType(T.DoubleType()))]))
    return l2_normalize(pooled, vec)


def _mean_vectors(batches):
    """Arrow function of a partition of (v, u, w): weighted mean of the vectors ``v`` per user in the lists ``u``."""
    known, total, weight = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors, lists = _matrix(pa.chunked_array([batch["v"]])), batch["u"]
        users, w = lists.flatten(), batch["w"].flatten().to_numpy()
        if known is None:
            known, total, weight = users.slice(0, 0), np.zeros((0, vectors.shape[1])), np.zeros(0)
        new = users.unique()
        new = new.filter(pc.is_null(pc.index_in(new, value_set=known)))
        if len(new):
            known = pa.concat_arrays([known, new])
            total = np.concatenate([total, np.zeros((len(new), total.shape[1]))])
            weight = np.concatenate([weight, np.zeros(len(new))])
        at = pc.index_in(users, value_set=known).to_numpy().astype(np.int64)
        of = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        order = np.argsort(at, kind="stable")
        at, of, w = at[order], of[order], w[order]
        for lo in range(0, len(at), PIECE):
            a, x = at[lo:lo + PIECE], w[lo:lo + PIECE]
            first = np.flatnonzero(np.diff(a, prepend=-1))
            total[a[first]] += np.add.reduceat(vectors[of[lo:lo + PIECE]] * x[:, None], first, axis=0)
            weight[a[first]] += np.add.reduceat(x, first)
    if known is not None:
        for lo in range(0, len(known), PIECE // 16):
            mean = total[lo:lo + PIECE // 16] / weight[lo:lo + PIECE // 16, None]
            ends = np.arange(0, mean.size + 1, mean.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([known.slice(lo, len(mean)), pa.ListArray.from_arrays(pa.array(ends), pa.array(mean.ravel()))],
                                             names=["u", "v"])


def resolve_seed(requests: DataFrame, items: DataFrame, seed: str = "seed_id", item: str = "item_id") -> DataFrame:
    """The seed id itself if it exists, else id + 1, else id - 1 (null if none)."""
    ids = items.select(item).distinct()
    out = requests
    for name, off in (("_s0", 0), ("_s1", 1), ("_s2", -1)):
        cand = ids.select(F.col(item).alias(name), (F.col(item) - off).alias("_k"))
        out = out.join(cand, out[seed] == cand["_k"], "left").drop("_k")
    return out.withColumn("resolved_id", F.coalesce("_s0", "_s1", "_s2")).drop("_s0", "_s1", "_s2")


def target_position_masked(queries: DataFrame, items: DataFrame, history: DataFrame, qid: str = "qid",
                           item: str = "item_id", vec: str = "vec", ties: str = "id") -> DataFrame:
    """Position of the target among all items except the query's own history (PAD-free ids).

    position = 1 + #items beating the target (blocked count) - #history items beating it
    (history pairs scored by equi-join).  No ranking is materialised.
    """
    pos = target_position(queries, items, qid=qid, item=item, vec=vec, ties=ties)
    items_v = items.select(F.col(item).alias("_hid"), F.col(vec).alias("_hv"))
    tv = items.select(F.col(item).alias("target_id"), F.col(vec).alias("_tv"))
    qt = (queries.select(F.col(qid).alias("_q"), F.col(vec).alias("_qv"), "target_id").join(tv, "target_id")
          .withColumn("_ts", dot(F.col("_qv"), F.col("_tv"))).drop("_tv"))
    h = (history.select(F.col(qid).alias("_q"), F.col(item).alias("_hid")).distinct()
         .join(qt, "_q").where(F.col("_hid") != F.col("target_id")).join(items_v, "_hid")
         .withColumn("_s", dot(F.col("_qv"), F.col("_hv"))))
    beat = F.col("_s") > F.col("_ts")
    if ties != "optimistic":
        same = F.col("_s") == F.col("_ts")
        beat = beat | (same if ties == "pessimistic" else same & (F.col("_hid") < F.col("target_id")))
    nh = h.groupBy("_q").agg(F.count_if(beat).alias("_nh"))
    return (pos.join(nh, pos[qid] == nh["_q"], "left")
            .select(qid, "target_id", (F.col("position") - F.coalesce("_nh", F.lit(0))).cast("bigint").alias("position")))
