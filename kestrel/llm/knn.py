"""Operator 7: exact top-k by inner product with a Voronoi join.

Data and queries are grouped by their nearest pivot.  Each cell has a summary
(rows, largest norm, smallest and largest distance from the pivot).  A query's
k-th best score among the pivots' sample is a lower bound of its k-th best
score overall; a cell's summary gives an upper bound of any score in it, so a
query is replicated only to the cells that may still hold one of its results.
Cells are cut into blocks of bounded size, so a cell with a third of all rows
is many tasks; every (cell, block) solves its queries locally, and the local
top-k lists are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.store import Scratch, columns
from kestrel.plans.topk import top_k

K = 10
PIVOTS = 64          # cells
SAMPLE = 1024        # rows of the bounded sample: pivots come from it, bounds are scored on it
BLOCK_ROWS = 4096    # data rows of one task
QUERY_ROWS = 8192    # queries of one task
_EXACT = 2.0 ** 53


def integer_vectors(table: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` -> (vec_id, vec array<bigint>) with floor(1024 x) per component.

    Rows without an id or a vector, and vectors with a null or non-finite component, take no part."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (table.select(*columns(table, "vec_id", "embedding"))
            .where(F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False)))
            .select("vec_id", F.transform(x, lambda v: F.floor(v.cast("double") * 1024).cast("bigint")).alias("vec")))


def _matrix(column, dims: int) -> np.ndarray:
    """(rows, dims) int64; a shorter vector is padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    n = np.diff(column.offsets.to_numpy())
    if len(n) and (n == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(n), dims), np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; doubles carry them while every partial sum is below 2**53."""
    if q.size and x.size and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < _EXACT:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return q @ x.T


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice of ``n`` different rows of the sample."""
    points = np.unique(sample, axis=0).astype(float)
    if len(points) <= n:
        return points
    chosen = [0]
    far = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < n:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x ** 2).sum(axis=1)[:, None] + (pivots ** 2).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def assign(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot's ``cell``, the distance ``dist`` from it and the ``norm``."""
    dims = pivots.shape[1]

    def run(batches):
        for batch in batches:
            x = _matrix(batch["vec"], dims).astype(float)
            d = _distances(x, pivots)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["vec"], pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell]),
                 pa.array(np.sqrt((x ** 2).sum(axis=1)))], names=["vec_id", "vec", "cell", "dist", "norm"])
    return vectors.mapInArrow(run, "vec_id bigint, vec array<bigint>, cell int, dist double, norm double")


def route(queries: DataFrame, pivots: np.ndarray, summary: dict, sample: tuple[np.ndarray, np.ndarray],
          k: int) -> DataFrame:
    """``queries(query_id, vec)`` -> (query_id, vec, floor, cell): one row per cell that may
    hold a result.  ``floor``: the query's k-th best score in the sample."""
    dims = pivots.shape[1]
    ids, vectors = sample
    cells = np.array(sorted(summary), int)
    near = np.array([summary[c][0] for c in cells])
    far = np.array([summary[c][1] for c in cells])
    norm = np.array([summary[c][2] for c in cells])
    centre = pivots[cells]

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                q = _matrix(part["vec"], dims)
                own = part["query_id"].to_numpy()
                s = np.where(own[:, None] == ids[None, :], np.iinfo(np.int64).min, scores(q, vectors))
                low = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] >= k \
                    else np.full(len(q), np.iinfo(np.int64).min)
                x = q.astype(float)
                length = np.sqrt((x ** 2).sum(axis=1))[:, None]
                d = _distances(x, centre)
                # |q - x| >= gap for every x of the cell, and q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2.
                gap = np.maximum(0, np.maximum(d - far, near - d))
                high = np.minimum((length ** 2 + norm ** 2 - gap ** 2) / 2, x @ centre.T + length * far)
                high = np.minimum(high, length * norm)
                # A margin above rounding errors keeps every cell that could matter.
                keep = high + 1e-9 * (length * norm + length ** 2 + norm ** 2) + 1 >= low[:, None]
                row, cell = np.nonzero(keep)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part["query_id"].take(take), part["vec"].take(take), pa.array(low[row]),
                     pa.array(cells[cell].astype(np.int32))], names=["query_id", "vec", "floor", "cell"])
    return queries.mapInArrow(run, "query_id bigint, vec array<bigint>, floor bigint, cell int")


def solve(queries: pa.Table, data: pa.Table, dims: int, k: int) -> pa.Table:
    """Top k of every query within one block, ties to the smaller vec_id."""
    out_q, out_v, out_s = [], [], []
    if len(queries) and len(data):
        data = data.sort_by("vec_id")
        x, ids = _matrix(data["vec"], dims), data["vec_id"].to_numpy()
        qid, low = queries["query_id"].to_numpy(), queries["floor"].to_numpy()
        for at in range(0, len(queries), 256):
            s = scores(_matrix(queries["vec"].slice(at, 256), dims), x)
            for i, row in enumerate(s):
                fit = np.flatnonzero((row >= low[at + i]) & (ids != qid[at + i]))
                if len(fit) > k:
                    got = row[fit]
                    least = np.partition(got, len(got) - k)[len(got) - k]
                    above = fit[got > least]
                    # Rows are sorted by id, so the first of the tied ones are the right ones.
                    fit = np.concatenate([above, fit[got == least][:k - len(above)]])
                out_q.append(np.full(len(fit), qid[at + i]))
                out_v.append(ids[fit])
                out_s.append(row[fit])
    cat = lambda parts: pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64())
    return pa.table({"query_id": cat(out_q), "vec_id": cat(out_v), "score": cat(out_s)})


def voronoi_topk(queries: DataFrame, data: DataFrame, k: int = K, pivots: int = PIVOTS, sample_rows: int = SAMPLE,
                 block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``queries(query_id, vec)`` against ``data(vec_id, vec)`` -> query_id, rank, vec_id, score.

    Rows of ``data`` with the query's own id are not its candidates.  A query with
    fewer than k candidates gets all of them.  Repeated data rows are candidates each;
    a query id that occurs several times is searched once, with its smallest vector.
    Vectors of unequal length are padded with zeros.  Empty tables give an empty result.
    """
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    spark = data.sparkSession
    scratch = Scratch(spark)
    queries = queries.groupBy("query_id").agg(F.min("vec").alias("vec"))
    dims = data.agg(F.max(F.size("vec")).alias("d")).first()["d"]
    longest = queries.agg(F.max(F.size("vec")).alias("d")).first()["d"]
    if dims is None or longest is None:
        return spark.sql("SELECT * FROM VALUES (1) t(x) WHERE false").selectExpr(
            *(f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in schema.split(", ")))
    dims = max(dims, longest, 1)
    # A bounded sample in hash order: the same rows at any partitioning.
    some = data.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(sample_rows).toArrow()
    sample = some["vec_id"].to_numpy(), _matrix(some["vec"], dims)
    centres = choose_pivots(sample[1], pivots)
    placed = scratch.write(assign(data, centres))
    summary = {r["cell"]: (r["near"], r["far"], r["norm"], r["n"]) for r in placed.groupBy("cell").agg(
        F.min("dist").alias("near"), F.max("dist").alias("far"), F.max("norm").alias("norm"),
        F.count(F.lit(1)).alias("n")).collect()}
    routed = scratch.write(route(queries, centres, summary, sample, k))
    waiting = {r["cell"]: r["n"] for r in routed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}

    def per_cell(counts: dict, rows: int) -> F.Column:
        """Number of blocks of the row's cell; at most one literal per pivot."""
        return F.get(F.array(*[F.lit(max(1, -(-counts.get(c, 0) // rows))) for c in range(len(centres))]), F.col("cell"))

    blocks = per_cell({c: v[3] for c, v in summary.items()}, block_rows)
    turns = per_cell(waiting, query_rows)
    left = (routed.withColumn("turn", F.pmod(F.xxhash64("query_id"), turns).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))))
    right = (placed.where(F.col("cell").isin([c for c in waiting])).select("vec_id", "vec", "cell")
             # Equal ids would share a block; the vector's hash parts other rows evenly.
             .withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks).cast("int"))
             .withColumn("turn", F.explode(F.sequence(F.lit(0), turns - 1))))

    def local(q: pa.Table, d: pa.Table) -> pa.Table:
        return solve(q, d, dims, k)
    found = (left.groupBy("cell", "block", "turn").cogroup(right.groupBy("cell", "block", "turn"))
             .applyInArrow(local, "query_id bigint, vec_id bigint, score bigint"))
    best = top_k(found, ["query_id"], [F.col("score").desc(), F.col("vec_id")], k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def knn_query(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by ``every``; candidates: all others."""
    vectors = Scratch(embeddings.sparkSession).write(integer_vectors(embeddings))
    queries = vectors.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vec")
    return voronoi_topk(queries, vectors)
