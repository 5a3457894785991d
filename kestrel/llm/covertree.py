"""Operator 12: hard negatives by cover trees over norm-augmented vectors.

Every candidate gets one more coordinate, ``sqrt(M^2 - |x|^2)`` with M the largest norm,
so all lie on one sphere and an anchor's inner product falls with the angle to it.  The
upper levels of the tree are cells around pivots, with their covering radii; a cell is
cut into blocks of bounded size, and every block builds the lower levels in its task:
nodes of nearby points, each with the radius that covers all below it.

An anchor's search has a window of scores.  A node's centre and radius bound every score
below it, so cells and nodes outside the window are skipped, whatever is below them.  The
others are taken best bound first until k verified scores are above all that is left.
Positives are the search without a window among rows of the anchor's label, negatives the
search in the window that a positive's score sets among rows of the other labels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.knn import _matrix as matrix
from kestrel.llm.knn import choose_pivots, scores
from kestrel.llm.store import Scratch, columns
from kestrel.plans.topk import top_k

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90     # percent of the positive's score
PIVOTS = 64            # cells
SAMPLE = 1024          # rows of the bounded sample: pivots, and a first bound of every search
BLOCK_ROWS = 4096      # data rows of one tree
QUERY_ROWS = 4096      # anchors of one task
FAN_OUT, LEAF = 8, 64
BASE = 1.5             # radii shrink by this from level to level, unless FAN_OUT stops them
AT_ONCE = 8            # leaves that a search opens first
_NONE = -np.iinfo(np.int64).max  # below every score; its negative is a number too
TOGETHER = 128         # anchors searched at once
ANY = 1 << 62          # ends of a search without a window

QUERY = "anchor_id bigint, label bigint, vec array<bigint>, windows array<struct<name:bigint,low:bigint,high:bigint>>"


def labelled_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, embedding, label)`` -> (vec_id, label, vec array<bigint>), components floor(scale * x).

    Rows without an id, a label or a vector, and vectors with a null or non-finite
    component, take no part."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (table.select(*columns(table, "vec_id", "embedding", "label"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
                    F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("bigint")).alias("vec")))


def augmented(x: np.ndarray, largest: float) -> np.ndarray:
    """Rows with the coordinate that brings each to norm ``largest``."""
    x = x.astype(float)
    return np.concatenate([x, np.sqrt(np.maximum(largest ** 2 - (x ** 2).sum(axis=1), 0))[:, None]], axis=1)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x ** 2).sum(axis=1)[:, None] + (c ** 2).sum(axis=1)[None, :] - 2 * x @ c.T, 0))


def score_bounds(at_centre: np.ndarray, length: np.ndarray, radius: np.ndarray, largest: float):
    """Lowest and highest score within ``radius`` of centres on the sphere, per (query, centre).

    The chord ``radius`` is an angle; a margin above rounding errors is added on both sides."""
    reach = np.maximum(length[:, None] * largest, 1e-300)
    angle = np.arccos(np.clip(at_centre / reach, -1, 1))
    # Near the poles rounding moves angles by the root of an ulp, and distances carry it too.
    wide = 2 * np.arcsin(np.clip(radius / (2 * max(largest, 1e-300)), 0, 1))[None, :] + 1e-6
    low = np.where(angle + wide >= np.pi, -reach, reach * np.cos(np.minimum(angle + wide, np.pi)))
    high = np.where(angle <= wide, reach, reach * np.cos(np.maximum(angle - wide, 0)))
    margin = 1 + 1e-9 * reach
    return low - margin, high + margin


class CoverTree:
    """Levels of nodes over one block of points; a node's radius covers every point below it."""

    def __init__(self, points: np.ndarray, fan_out: int = FAN_OUT, leaf: int = LEAF, base: float = BASE):
        #: per level: centre (point number), radius, parent (node of the level above)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        #: leaves: (level, node) and their points
        self.leaves: list[tuple[int, int]] = []
        self.members: list[np.ndarray] = []
        every = np.arange(len(points))
        far = np.sqrt(((points - points[0]) ** 2).sum(axis=1)) if len(points) else np.empty(0)
        todo = [(0, every, far, -1)] if len(points) else []
        while todo:
            nodes = [(c, float(d.max()), up) for c, _, d, up in todo]
            self.levels.append((np.array([x[0] for x in nodes]), np.array([x[1] for x in nodes]),
                                np.array([x[2] for x in nodes])))
            below = []
            for number, (centre, some, far, _) in enumerate(todo):
                if len(some) <= leaf or far.max() == 0:
                    for i in range(0, len(some), leaf):
                        self.leaves.append((len(self.levels) - 1, number))
                        self.members.append(some[i:i + leaf])
                    continue
                # The centre stays one on the level below; others are added, the farthest first.
                goal = far.max() / base
                centres, near, who = [centre], far.copy(), np.zeros(len(some), np.int64)
                while len(centres) < fan_out and near.max() > goal:
                    new = int(some[near.argmax()])
                    d = np.sqrt(((points[some] - points[new]) ** 2).sum(axis=1))
                    closer = d < near
                    who[closer] = len(centres)
                    near = np.minimum(near, d)
                    centres.append(new)
                if len(centres) == fan_out and 4 * np.bincount(who).max() > 3 * len(some):
                    # Only outliers were parted from a round cloud: cut it into shells around the centre.
                    who = np.empty(len(some), np.int64)
                    who[np.argsort(far, kind="stable")] = np.arange(len(some)) * fan_out // len(some)
                    centres = [int(some[who == i][0]) for i in range(fan_out)]
                for i, c in enumerate(centres):
                    mine = who == i
                    if mine.any():
                        exact = np.sqrt(((points[some[mine]] - points[c]) ** 2).sum(axis=1))
                        below.append((c, some[mine], exact, number))
            todo = below


class Search:
    """Windowed top-k of several anchors in one block's tree."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, largest: float):
        self.x, self.ids, self.labels, self.largest = x, ids, labels, largest
        self.tree = CoverTree(augmented(x, largest))
        self.leaf = np.zeros(len(x), np.int64)
        for i, m in enumerate(self.tree.members):
            self.leaf[m] = i

    def _leaf_bounds(self, q, owner, low, high):
        """Per window: the best score each leaf may hold; -inf where a level skips it."""
        length = np.sqrt((q.astype(float) ** 2).sum(axis=1))
        alive, best = None, []
        for centre, radius, parent in self.tree.levels:
            least, most = score_bounds(scores(q, self.x[centre]).astype(float), length, radius, self.largest)
            inside = (most[owner] >= low[:, None]) & (least[owner] <= high[:, None])
            alive = inside if alive is None else inside & alive[:, parent]
            best.append(np.where(alive, np.minimum(most[owner], high[:, None]), -np.inf))
        return np.stack([best[lv][:, node] for lv, node in self.tree.leaves], axis=1)

    def run(self, q, own, label, owner, low, high, k: int, same: bool):
        """``q[i]``: vector of anchor i with id ``own[i]``; window w belongs to anchor ``owner[w]``.
        (window, score, id) of every result, the best k of each window.

        Each round every window opens its best leaves, first AT_ONCE, then four times as many.
        What an anchor opens is verified for all its windows, and by one product with the leaves
        that the other anchors open."""
        best = (np.empty(0, np.int64),) * 3
        if not len(owner) or not len(self.tree.members):
            return best
        bound = self._leaf_bounds(q, owner, low, high)
        turn = AT_ONCE
        while True:
            n = min(turn, bound.shape[1])
            pick = np.argpartition(-bound, n - 1, axis=1)[:, :n]
            wanted, place = np.nonzero(np.take_along_axis(bound, pick, axis=1) > -np.inf)
            if not len(wanted):
                return best
            opened = np.zeros((len(q), bound.shape[1]), bool)
            opened[owner[wanted], pick[wanted, place]] = True
            anchor, point = np.flatnonzero(opened.any(axis=1)), np.flatnonzero(opened.any(axis=0)[self.leaf])
            value = scores(q[anchor], self.x[point])
            fits = ((self.labels[point] == label[anchor][:, None]) == same) & (self.ids[point] != own[anchor][:, None])
            fits &= opened[np.ix_(anchor, self.leaf[point])]
            value, column = _descending(np.where(fits, value, _NONE), fits)
            # Rows with an anchor's scores from the highest down: each window takes k from its upper end.
            window = np.flatnonzero(opened.any(axis=1)[owner])
            row = np.searchsorted(anchor, owner[window])
            first = np.zeros(len(window), np.int64)
            last = np.full(len(window), value.shape[1])
            while (first < last).any():
                mid = (first + last) // 2
                above = (first < last) & (value[row, np.minimum(mid, value.shape[1] - 1)] > high[window])
                first, last = np.where(above, mid + 1, first), np.where(above | (first >= last), last, mid)
            spot = first[:, None] + np.arange(k)
            ok = spot < value.shape[1]
            spot = np.minimum(spot, value.shape[1] - 1)
            got = value[row[:, None], spot]
            w, c = np.nonzero(ok & (got >= low[window, None]) & (got > _NONE))
            best = _best(np.concatenate([best[0], window[w]]), np.concatenate([best[1], got[w, c]]),
                         np.concatenate([best[2], self.ids[point[column[row[w], spot[w, c]]]]]), k)
            bound[opened[owner]] = -np.inf
            # A window with k results needs only leaves that may reach the last of them.
            full = np.bincount(best[0], minlength=len(owner)) >= k
            least = np.full(len(owner), np.inf)
            np.minimum.at(least, best[0], best[1].astype(float))
            bound[bound < np.where(full, least, -np.inf)[:, None] - 1] = -np.inf
            turn *= 4


def _descending(value: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every row from the highest value down, ties to the smaller column; (values, columns)."""
    bits = max(value.shape[1] - 1, 1).bit_length()
    if np.abs(value[real]).max(initial=0) < 1 << (61 - bits):
        # Value and column fit one number: sorting it needs no second array.
        packed = np.where(real, -value, 1 << (61 - bits))
        packed = np.sort((packed << bits) + np.arange(value.shape[1]), axis=1)
        column, value = packed & ((1 << bits) - 1), -(packed >> bits)
        return np.where(value == -(1 << (61 - bits)), _NONE, value), column
    column = np.argsort(-value, axis=1, kind="stable")
    return np.take_along_axis(value, column, axis=1), column


def _best(window, score, ids, k: int):
    """The k best of every window, ties to the smaller id; sorted by window."""
    order = np.lexsort((ids, -score, window))
    window, score, ids = window[order], score[order], ids[order]
    start = np.flatnonzero(np.diff(window, prepend=-1))
    place = np.arange(len(window)) - np.repeat(start, np.diff(np.append(start, len(window))))
    return window[place < k], score[place < k], ids[place < k]


def _windows(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, name, low, high) of every window of a batch."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    size = np.diff(column.offsets.to_numpy())
    name, low, high = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("name", "low", "high"))
    return np.repeat(np.arange(len(column)), size), name, low, high


def route(queries: DataFrame, pivots: np.ndarray, summary: dict, sample: tuple, largest: float, k: int,
          same: bool) -> DataFrame:
    """Queries with the cells that may hold a result, one row each, and windows narrowed to them.

    k scores of the sample inside a window raise its lower end to the least of them."""
    ids, labels, vectors = sample
    cells = np.array(sorted(summary), int)
    radius = np.array([summary[c][0] for c in cells])
    centre, dims = pivots[cells], vectors.shape[1]
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("name", "low", "high")]))

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                q = matrix(part["vec"], dims)
                own, label = part["anchor_id"].to_numpy(), part["label"].to_numpy()
                owner, name, low, high = _windows(part["windows"])
                s = scores(q, vectors)
                fits = (ids[None, :] != own[:, None]) & ((labels[None, :] == label[:, None]) == same)
                inside = np.where(fits, s, _NONE)[owner]
                inside = np.where((inside >= low[:, None]) & (inside <= high[:, None]), inside, _NONE)
                if inside.shape[1] >= k and len(inside):
                    low = np.maximum(low, np.partition(inside, -k, axis=1)[:, -k])
                length = np.sqrt((q.astype(float) ** 2).sum(axis=1))
                # A pivot's own last coordinate does not matter: an anchor has none.
                least, most = score_bounds(q.astype(float) @ centre[:, :dims].T, length, radius, largest)
                keep = (most[owner] >= low[:, None]) & (least[owner] <= high[:, None])
                window, cell = np.nonzero(keep)
                order = np.lexsort((window, cell, owner[window]))
                window, cell = window[order], cell[order]
                group = owner[window] * len(cells) + cell
                start = np.flatnonzero(np.diff(group, prepend=-1))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(start, len(window)).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(name[window]), pa.array(low[window]), pa.array(high[window])],
                                               names=["name", "low", "high"]))
                take = pa.array(owner[window[start]])
                yield pa.RecordBatch.from_arrays(
                    [part["anchor_id"].take(take), part["label"].take(take), part["vec"].take(take), lists.cast(kind),
                     pa.array(cells[cell[start]].astype(np.int32))],
                    names=["anchor_id", "label", "vec", "windows", "cell"])
    return queries.mapInArrow(run, QUERY + ", cell int")


class CoverIndex:
    """Cells of the candidates (written once) and the searches over them."""

    def __init__(self, data: DataFrame, pivots: int = PIVOTS, sample_rows: int = SAMPLE,
                 block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS):
        """``data(vec_id, label, vec)``; vectors of unequal length are padded with zeros."""
        self.scratch = Scratch(data.sparkSession)
        self.block_rows, self.query_rows = block_rows, query_rows
        square = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
        about = data.agg(F.max(F.size("vec")).alias("dims"), F.max(square).alias("square")).first()
        self.dims = max(about["dims"] or 0, 1)
        # A little above the largest norm, so that rounding leaves no point outside the sphere.
        self.largest = float(np.sqrt(about["square"] or 0.0)) * (1 + 1e-12)
        some = data.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(sample_rows).toArrow()
        self.sample = (some["vec_id"].to_numpy(), some["label"].to_numpy(), matrix(some["vec"], self.dims))
        self.pivots = choose_pivots(augmented(self.sample[2], self.largest), pivots)
        self.placed = self.scratch.write(self._assigned(data))
        self.summary = {r["cell"]: (r["radius"], r["n"]) for r in self.placed.groupBy("cell").agg(
            F.max("dist").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}

    def _assigned(self, data: DataFrame) -> DataFrame:
        dims, largest, pivots = self.dims, self.largest, self.pivots

        def run(batches):
            for batch in batches:
                d = _distances(augmented(matrix(batch["vec"], dims), largest), pivots)
                cell = d.argmin(axis=1) if len(d) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], batch["label"], batch["vec"], pa.array(cell.astype(np.int32)),
                     pa.array(d[np.arange(len(d)), cell])], names=["vec_id", "label", "vec", "cell", "dist"])
        return data.select("vec_id", "label", "vec").mapInArrow(
            run, "vec_id bigint, label bigint, vec array<bigint>, cell int, dist double")

    def search(self, queries: DataFrame, k: int, same_label: bool) -> DataFrame:
        """``queries`` (see QUERY) -> anchor_id, name, rank, vec_id, score: per window the k best
        scores inside it among rows with (or without) the anchor's label, its own id aside."""
        dims, largest = self.dims, self.largest
        schema = "anchor_id bigint, name bigint, vec_id bigint, score bigint"
        routed = self.scratch.write(route(queries, self.pivots, self.summary, self.sample, largest, k, same_label))
        waiting = {r["cell"]: r["n"] for r in routed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}

        def per_cell(counts: dict, rows: int) -> F.Column:
            return F.get(F.array(*[F.lit(max(1, -(-counts.get(c, 0) // rows))) for c in range(len(self.pivots))]), F.col("cell"))

        def local(q: pa.Table, d: pa.Table) -> pa.Table:
            out = [[], [], [], []]
            if len(q) and len(d):
                d = d.sort_by("vec_id")
                tree = Search(matrix(d["vec"], dims), d["vec_id"].to_numpy(), d["label"].to_numpy(), largest)
                for at in range(0, len(q), TOGETHER):
                    part = q.slice(at, TOGETHER)
                    owner, name, low, high = _windows(part["windows"])
                    own = part["anchor_id"].to_numpy()
                    row, score, found = tree.run(matrix(part["vec"], dims), own, part["label"].to_numpy(), owner, low,
                                                 high, k, same_label)
                    for o, x in zip(out, (own[owner[row]], name[row], found, score)):
                        o.append(x)
            cat = [pa.array(np.concatenate(o) if o else np.empty(0, np.int64), pa.int64()) for o in out]
            return pa.table(dict(zip(("anchor_id", "name", "vec_id", "score"), cat)))

        blocks = per_cell({c: v[1] for c, v in self.summary.items()}, self.block_rows)
        turns = per_cell(waiting, self.query_rows)
        left = (routed.withColumn("turn", F.pmod(F.xxhash64("anchor_id"), turns).cast("int"))
                .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))))
        right = (self.placed.where(F.col("cell").isin(list(waiting))).select("vec_id", "label", "vec", "cell")
                 .withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), blocks).cast("int"))
                 .withColumn("turn", F.explode(F.sequence(F.lit(0), turns - 1))))
        found = (left.groupBy("cell", "block", "turn").cogroup(right.groupBy("cell", "block", "turn"))
                 .applyInArrow(local, schema))
        return top_k(found, ["anchor_id", "name"], [F.col("score").desc(), F.col("vec_id")], k)


def hard_negatives(anchors: DataFrame, data: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, **how) -> DataFrame:
    """``anchors`` and ``data`` (vec_id, label, vec) -> anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    An anchor's positives are its ``positives`` best other rows of its label; a positive's
    negatives the ``negatives`` best rows of other labels whose score lies between ``low``
    and ``high`` percent of the positive's.  Ties go to the smaller vec_id; fewer rows give
    fewer results, and a negative positive score leaves no window.  Rows of ``data`` with
    the anchor's own id are neither.  Repeated data rows count each; a repeated anchor is
    searched once, with its smallest (vec, label).  Empty tables give an empty result.
    """
    index = CoverIndex(data, **how)
    once = index.scratch.write(anchors.groupBy("vec_id").agg(F.min(F.struct("vec", "label")).alias("r"))
                               .select(F.col("vec_id").alias("anchor_id"), "r.label", "r.vec"))
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("name"), F.lit(-ANY).alias("low"), F.lit(ANY).alias("high")))
    found = index.search(once.select("anchor_id", "label", "vec", whole.alias("windows")), positives, True)
    found = index.scratch.write(found.select("anchor_id", F.col("rank").alias("name"), F.col("vec_id").alias("positive_id"),
                                             F.col("score").alias("positive_score")))
    least, most = F.lit(low) * F.col("positive_score"), F.lit(high) * F.col("positive_score")
    window = F.struct(F.col("name").cast("bigint").alias("name"),
                      F.expr("(_least + pmod(-_least, 100L)) div 100").alias("low"),
                      F.expr("(_most - pmod(_most, 100L)) div 100").alias("high"))
    sought = (found.withColumn("_least", least.cast("bigint")).withColumn("_most", most.cast("bigint"))
              .where("_least <= _most").groupBy("anchor_id").agg(F.sort_array(F.collect_list(window)).alias("windows"))
              .join(once, "anchor_id").select("anchor_id", "label", "vec", "windows"))
    mined = index.search(sought, negatives, False)
    return (mined.join(found, ["anchor_id", "name"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def negatives_query(embeddings: DataFrame, every: int = 100, moved: int = 7, labels: int = 10) -> DataFrame:
    """Anchors: rows whose vec_id is divisible by ``every``.  Where it is divisible by ``moved``,
    the label is first moved on by one, modulo ``labels``."""
    vectors = labelled_vectors(embeddings).withColumn(
        "label", F.when(F.col("vec_id") % moved == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))
    vectors = Scratch(embeddings.sparkSession).write(vectors)
    return hard_negatives(vectors.where(F.col("vec_id") % every == 0), vectors)
