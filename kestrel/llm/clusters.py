"""Exact verification of set similarity inside candidate clusters.

A candidate step (banding, prefix filter) links sets that may be similar; the
connected components of these links are clusters.  Here every cluster's sets are
compared exactly: each set is shipped once, and a cluster whose sets exceed one
task's share is dealt to blocks, with one task per pair of blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_TOKENS = 1_000_000   # set elements of one block (8 bytes each)


def block_pairs(members: DataFrame, sizes: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``members(cluster, node, n, ...)`` dealt to tasks: groups of the column ``task``.

    ``sizes(cluster, tokens)`` gives each cluster's elements.  A cluster above one task's
    share is cut into nb blocks, and a set in block b goes to the nb tasks that compare b with
    every block.  Smaller clusters share tasks, about ``block_tokens`` elements each (see
    ``by_cluster``): a task for every pair of lines would cost more than its comparison."""
    nb = F.greatest(F.ceil(F.col("tokens") / F.lit(block_tokens)).cast("int"), F.lit(1))
    known = sizes.select("cluster", "tokens", nb.alias("_nb"))
    small = known.where("_nb = 1").agg(F.sum("tokens").alias("n")).first()["n"] or 0
    shared = F.pmod(F.xxhash64("cluster"), F.lit(max(1, -(-small // block_tokens))))
    b = F.pmod(F.xxhash64("node"), F.col("_nb")).cast("int")
    return (members.join(known.drop("tokens"), "cluster")
            .withColumn("_b", b)
            .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
            .withColumn("task", F.when(F.col("_nb") == 1, F.struct(F.lit(0).alias("c"), shared.alias("i"), F.lit(-1).alias("j")))
                        .otherwise(F.struct(F.xxhash64("cluster").alias("c"), F.least("_b", "_o").cast("bigint").alias("i"),
                                            F.greatest("_b", "_o").alias("j"))))
            .drop("_nb", "_b", "_o"))


def by_cluster(table: pa.Table) -> list[pa.Table]:
    """One task's rows, cluster by cluster."""
    table = table.sort_by("cluster").combine_chunks()
    names = table["cluster"].combine_chunks() if isinstance(table["cluster"], pa.ChunkedArray) else table["cluster"]
    if not len(names):
        return [table]
    cut = np.flatnonzero(pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)) + 1
    return [table.slice(i, j - i) for i, j in zip([0, *cut], [*cut, len(names)])]


def member_bits(members: DataFrame, bits: int = 1 << 24) -> np.ndarray:
    """Bit set over hashes of (doc_id, th): a fixed 2 MB whatever the number of members."""
    slot = F.pmod(F.xxhash64("doc_id", "th"), F.lit(bits)).cast("bigint")
    words = (members.select(slot.alias("slot"))
             .groupBy(F.shiftright("slot", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(slot & 63 AS INT)))").alias("bits")).toArrow())
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def only_members(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """Rows of ``docs(doc_id, th, text)`` whose bit is set: fewer texts enter the join's shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    n = len(bits) * 64

    def run(batches):
        for batch in batches:
            slot = batch["slot"].to_numpy()
            hit = (shared.value[slot >> 6] >> (slot & 63)) & 1
            yield batch.filter(pa.array(hit.astype(bool)))
    slotted = docs.withColumn("slot", F.pmod(F.xxhash64("doc_id", "th"), F.lit(n)).cast("bigint"))
    return slotted.mapInArrow(run, slotted.schema).drop("slot")


class Postings:
    """Inverted index over the sets of one task."""

    def __init__(self, blobs: pa.Array):
        sets = blobs.cast(pa.large_binary())
        buf = sets.buffers()
        at = np.frombuffer(buf[1], np.int64)[sets.offset:sets.offset + len(sets) + 1]
        tokens = np.frombuffer(buf[2], np.uint64, count=int(at[-1] - at[0]) // 8, offset=int(at[0])) if at[-1] > at[0] \
            else np.empty(0, np.uint64)
        self.n = np.diff(at) // 8
        owner = np.repeat(np.arange(len(self.n)), self.n)
        order = np.argsort(tokens, kind="stable")
        ranked = tokens[order]
        fresh = np.ones(len(ranked), bool)
        fresh[1:] = ranked[1:] != ranked[:-1]
        ids = np.empty(len(tokens), np.int64)
        ids[order] = np.cumsum(fresh) - 1
        self.members = owner[order]
        self.start = np.append(np.flatnonzero(fresh), len(ranked))
        self.df = np.diff(self.start)
        self.ids, self.at = ids, (at - at[0]) // 8
        self.weight = np.bincount(owner, weights=self.df[ids], minlength=len(self.n)) if len(ids) \
            else np.zeros(len(self.n))

    def overlap(self, x: int) -> np.ndarray:
        """Intersection size of set x with every set."""
        tokens = self.ids[self.at[x]:self.at[x + 1]]
        tokens = tokens[self.df[tokens] > 1]
        lens = self.df[tokens]
        total = int(lens.sum())
        if not total:
            out = np.zeros(len(self.n), np.int64)
        else:
            shift = np.repeat(self.start[tokens] - (np.cumsum(lens) - lens), lens)
            out = np.bincount(self.members[shift + np.arange(total)], minlength=len(self.n))
        out[x] = self.n[x]
        return out

    def similar(self, x: int, percent: int) -> np.ndarray:
        both = self.overlap(x)
        return 100 * both >= percent * (self.n[x] + self.n - both)


def _two(table: pa.Table, percent: int) -> bool:
    """Whether the two sets of a table are similar; most clusters are pairs."""
    a, b = (np.frombuffer(x, np.uint64) for x in table["set"].to_pylist())
    both = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
    return 100 * both >= percent * (len(a) + len(b) - both)


def links(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Index pairs that span the components of one task's similarity graph.

    The component around the most central set is found first; its members need no
    comparison of their own, since every set outside it is compared with all."""
    if len(table) == 2:
        return [(0, 1)] if _two(table, percent) else []
    index = Postings(table["set"].combine_chunks())
    label = np.arange(len(index.n))
    order = np.argsort(-index.weight, kind="stable")
    out = []
    for k, x in enumerate(order):
        if k and label[x] == label[order[0]]:
            continue
        hit = np.flatnonzero(index.similar(x, percent))
        _, first = np.unique(label[hit], return_index=True)
        for y in hit[first]:
            if label[y] != label[x]:
                out.append((int(x), int(y)))
                # The central component keeps its label.
                old, new = (label[x], label[y]) if label[y] == label[order[0]] else (label[y], label[x])
                label[label == old] = new
    return out


def matched(table: pa.Table, percent: int, order: list[str]) -> np.ndarray:
    """Mask of the sets of one task that are similar to an earlier one (by ``order``).

    A set already matched is not compared again: every unmatched one is compared
    with all, so what a matched set could still match is found from the other side."""
    if len(table) == 2:
        keys = [tuple(table[c][i].as_py() for c in order) for i in (0, 1)]
        return np.array([keys[i] > keys[1 - i] for i in (0, 1)]) & _two(table, percent)
    index = Postings(table["set"].combine_chunks())
    rank = np.empty(len(index.n), np.int64)
    by_time = np.lexsort([table[c].to_numpy() for c in reversed(order)])
    rank[by_time] = np.arange(len(rank))
    done = np.zeros(len(rank), bool)
    for x in by_time:
        if done[x]:
            continue
        hit = index.similar(x, percent)
        done |= hit & (rank > rank[x])
        done[x] = bool((hit & (rank < rank[x])).any())
    return done
