"""Operator 13: n-gram Jaccard join by PartEnum signatures.

A document is its set of distinct 4-word shingles.  Set sizes are cut into bands
whose ends differ by the similarity, so similar sets lie in the same band or in
neighbouring ones; each set takes part in the instance of its own band and in the
next one.  Two sets of an instance that are similar differ in at most k elements.
The shingle domain is dealt to first-level parts, of which at least one holds at
most one of these differences, and each part to three second-level parts, of which
two then agree entirely.  A signature is what the set holds in two of the three, so
similar sets share one exactly: nothing is left to chance.

Signatures travel in packed blocks, one row per task flush and shard, and repeated
ones are linked before they travel, so a group of near copies ships one signature a
flush.  Inside a shard equal signatures link their sets; connected sets are candidate
clusters, in which full sets are compared exactly.  Chance equalities chain more and more
sets as a corpus grows, so large clusters are split first: of every set a bit map of about
a bit an element bounds the difference of a pair from below, and only pairs that it does
not rule out stay linked.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.clusters import BLOCK_TOKENS, block_pairs
from kestrel.llm.components import connected_components
from kestrel.llm.minhash import class_key, link_classes, shingle_sets
from kestrel.llm.store import Scratch, columns
from kestrel.llm.text import fmix, pieces

WORDS = 4
THRESHOLD = 85            # percent
SECOND, DIFFERENT = 3, 1  # second-level parts, and how many of them may differ
SHARD = 2_000_000         # signatures of one shard
FLUSH = 3_000_000         # signatures a task packs together
LARGE = BLOCK_TOKENS      # set elements above which a candidate cluster is split: more than one task compares
NODES = 32_768            # bit maps of one block (a wide one counts more)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SALT = fmix(np.arange(1, 4, dtype=np.uint64) * _MIX)


class Bands:
    """Size bands up to ``largest`` and the shape of every band's instance."""

    def __init__(self, percent: int, largest: int, second: int = SECOND, different: int = DIFFERENT):
        ends, low = [], 1
        while not ends or ends[-1] < largest:
            ends.append(low * 100 // percent)
            low = ends[-1] + 1
        ends.append(low * 100 // percent)          # the next band of the last one
        self.ends = np.array(ends)
        # Similar sets of an instance differ in at most this many elements.
        self.k = 2 * self.ends * (100 - percent) // (100 + percent)
        parts = -(-(self.k + 1) // (different + 1))
        # Spare parts: so many more agree, so that empty signatures may be left out (see signatures).
        self.spare = np.where(parts >= 3, 1 + parts // 16, 0)
        # Without a difference only equal sets are similar, and those are one class already.
        self.parts = np.where(self.k > 0, parts + self.spare, 0)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, sizes)


def signatures(values: np.ndarray, offsets: np.ndarray, percent: int = THRESHOLD,
               second: int = SECOND, different: int = DIFFERENT) -> tuple[np.ndarray, np.ndarray]:
    """(set number, 64-bit signature) for the sets ``values[offsets[i]:offsets[i + 1]]``.

    Part p of an instance gives one signature per choice of ``second - different`` of its
    second-level parts.  An empty signature says little and would gather many sets, so a
    set leaves its empty ones out while it has at most ``spare`` parts with one: then one
    of the parts that must agree still gives a signature with elements."""
    sizes = np.diff(offsets)
    bands = Bands(percent, int(sizes.max(initial=1)), second, different)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place, weight = fmix(values ^ _SALT[0]), fmix(values ^ _SALT[1])
    sub = (place & np.uint64(0xFFFF)) % np.uint64(second)
    who, keys = [], []
    for ahead in (0, 1):
        band = bands.of(sizes) + ahead
        parts = np.where(sizes > 0, bands.parts[np.minimum(band, len(bands.parts) - 1)], 0)
        base = np.cumsum(parts) - parts
        total = int(parts.sum())
        if not total:
            continue
        use = parts[owner] > 0
        part = ((place[use] >> np.uint64(32)) * parts[owner[use]].astype(np.uint64)) >> np.uint64(32)
        cell = (base[owner[use]].astype(np.uint64) + part) * np.uint64(second) + sub[use]
        cell = cell.astype(np.int64)
        held = np.zeros(total * second, np.uint64)
        np.add.at(held, cell, weight[use])
        count = np.bincount(cell, minlength=total * second).reshape(-1, second)
        held = held.reshape(-1, second)
        owned = np.repeat(np.arange(len(sizes)), parts)
        number = np.arange(total) - base[owned]
        name = fmix(band[owned].astype(np.uint64) * np.uint64(1 << 40) + number.astype(np.uint64) * np.uint64(64))
        chosen = list(combinations(range(second), second - different))
        filled = np.stack([count[:, c].sum(axis=1) > 0 for c in chosen])
        poor = np.bincount(owned, weights=~filled.all(axis=0), minlength=len(sizes))
        every = (poor > bands.spare[np.minimum(band, len(bands.spare) - 1)])[owned]
        for i, c in enumerate(chosen):
            emit = filled[i] | every
            who.append(owned[emit])
            keys.append(fmix(held[emit][:, c].sum(axis=1) * _MIX + name[emit] + np.uint64(i + 1)))
    if not who:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(who), np.concatenate(keys)


def _linked(order_key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by (key, node): mask of each key's first row, and edges to it from the other nodes."""
    first = np.ones(len(order_key), bool)
    first[1:] = order_key[1:] != order_key[:-1]
    head = node[np.maximum.accumulate(np.where(first, np.arange(len(node)), 0))] if len(node) else node
    edge = ~first & (node != head)
    return first, node[edge], head[edge]


def _packed(ascending: np.ndarray) -> bytes:
    """Sorted numbers as compressed byte planes of their differences."""
    steps = np.diff(ascending.view(np.uint64), prepend=np.uint64(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel()).view(np.int64)


def _unique_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(a):
        return a, b
    pairs = np.unique(np.stack([a, b], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def bit_maps(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Of every set the parities of its elements in 2^j >= size slots (64 at least), as bytes.

    Two maps of one length differ in at most as many bits as the sets in elements; a map's
    halves, one upon the other, are the map of half the length."""
    sizes = np.diff(offsets)
    slots = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    ends = np.append(0, np.cumsum(slots))
    at = fmix(values ^ _SALT[2]) & np.repeat(slots - 1, sizes).astype(np.uint64)
    odd = np.bincount(at.astype(np.int64) + np.repeat(ends[:-1], sizes), minlength=int(ends[-1])) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little")
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [
        None, pa.py_buffer((ends // 8).astype(np.int64).tobytes()), pa.py_buffer(packed.tobytes())]).cast(pa.binary())


def _folded(maps: list[bytes]) -> np.ndarray:
    """Bit maps as rows of words, folded to the shortest one's length."""
    sizes = np.array([len(x) // 8 for x in maps])
    out = np.empty((len(maps), sizes.min()), np.uint64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        rows = np.frombuffer(b"".join(maps[i] for i in at), np.uint64).reshape(len(at), size)
        while rows.shape[1] > out.shape[1]:
            half = rows.shape[1] // 2
            rows = rows[:, :half] ^ rows[:, half:]
        out[at] = rows
    return out


def near_pairs(group: np.ndarray, n: np.ndarray, maps: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Index pairs that link, inside each group, all sets that sizes and bit maps do not tell apart."""
    order = np.lexsort((n, group))
    group, n, rows = group[order], n[order], _folded([maps[i] for i in order])
    parent, out = np.arange(len(n)), []

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first, step = np.arange(len(n)), 0
    while len(first):
        # The set ``step`` places on is larger; beyond one that is too large all are.
        step += 1
        first = first[first + step < len(n)]
        other = first + step
        near = (group[first] == group[other]) & (100 * n[first] >= percent * n[other])
        first, other = first[near], other[near]
        apart = parent[first] != parent[other]
        a, b = first[apart], other[apart]
        differ = np.bitwise_count(rows[a] ^ rows[b]).sum(axis=1, dtype=np.int64)
        hit = (100 + percent) * differ <= (100 - percent) * (n[a] + n[b])
        for x, y in zip(a[hit].tolist(), b[hit].tolist()):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[ry] = rx
                out.append((int(order[x]), int(order[y])))
        if hit.any():
            while (parent != (up := parent[parent])).any():
                parent[:] = up
    return out


def split_clusters(members: DataFrame, percent: int = THRESHOLD, nodes: int = NODES) -> DataFrame:
    """``members(cluster, node, n, bits)`` -> edges (a, b) between nodes that may be similar, enough of
    them to connect every such pair.

    Similar sizes lie in one size class or in two that follow each other, so a node joins the instance
    of its own class and that of the class before it; an instance above ``nodes`` is dealt to blocks."""
    # A little wider than the similarity allows: rounding must not put a pair two classes apart.
    width = 1.001 * float(np.log(100 / percent)) if percent < 100 else 1e-9
    own = F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("bigint")
    placed = (members.select("cluster", "node", "n", "bits", F.explode(F.array(own, own - 1)).alias("_in"))
              .select(F.struct("cluster", "_in").alias("cluster"), "node", "n", "bits"))
    sizes = placed.groupBy("cluster").agg(F.sum(1 + F.shiftright("n", 9)).alias("tokens"))

    def near(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        inside = pa.chunked_array(table["cluster"]).combine_chunks()
        group, level = (inside.field(x).to_numpy(zero_copy_only=False) for x in ("cluster", "_in"))
        n, node = table["n"].to_numpy(), table["node"].to_numpy()
        found = []
        for one in np.unique(level):
            at = np.flatnonzero(level == one)
            maps = table["bits"].take(pa.array(at)).to_pylist()
            found.append(at[np.array(near_pairs(group[at], n[at], maps, percent), np.int64).reshape(-1, 2)])
        found = np.concatenate(found)
        return pa.table({"a": pa.array(node[found[:, 0]]), "b": pa.array(node[found[:, 1]])})

    return (block_pairs(placed, sizes, nodes).select("task", "cluster", "node", "n", "bits")
            .groupBy("task").applyInArrow(near, "a bigint, b bigint"))


def sketched(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs(doc_id, th, text)`` -> doc_id, th, n_shingles, class (of equal sets), bits (see bit_maps)."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                sets, offsets = shingle_sets(part["text"], words)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["th"], pa.array(np.diff(offsets)), class_key(sets, offsets), bit_maps(sets, offsets)],
                    names=["doc_id", "th", "n_shingles", "class", "bits"])
    return docs.mapInArrow(run, "doc_id bigint, th bigint, n_shingles bigint, class binary, bits binary")


def candidate_edges(docs: DataFrame, shards: int, words: int = WORDS, percent: int = THRESHOLD,
                    flush: int = FLUSH) -> DataFrame:
    """Edges (a, b) between the 64-bit class heads of sets that share a signature.

    Packed rows: of a shard's signatures 40 bits besides the shard, and the heads, in the
    order of these, as compressed differences.  Chance equality costs a comparison, never a link."""
    def pack(node, key):
        # (key, node) order; equal signatures of this flush become edges here.
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        first, a, b = _linked(key, node)
        key, node = key[first], node[first]
        a, b = _unique_edges(a, b)
        shard = ((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        cut = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64)) if shards < len(key) else None
        names = np.flatnonzero(np.diff(cut)) if cut is not None else np.unique(shard).astype(np.int64)
        lo = cut[names] if cut is not None else np.searchsorted(shard, names.astype(np.uint64))
        hi = np.append(lo[1:], len(key))
        rows = [names, [], [], []]
        for i, j in zip(lo, hi):
            order = i + np.argsort(node[i:j], kind="stable")
            mine = key[order]
            rows[1].append((mine & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes())
            rows[2].append((mine >> np.uint64(32)).astype(np.uint8).tobytes())
            rows[3].append(_packed(node[order]))
        # The edges found here ride along with the first row.
        ride = [np.stack([a, b], axis=1).tobytes()] + [b""] * (len(names) - 1) if len(names) else []
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[0].astype(np.int32)), *(pa.array(x, pa.binary()) for x in rows[1:]), pa.array(ride, pa.binary())],
            names=["shard", "low", "high", "node", "edges"])

    def run(batches):
        nodes, keys, size = [], [], 0
        for batch in batches:
            for part in pieces(batch, "text"):
                sets, offsets = shingle_sets(part["text"], words)
                classes = class_key(sets, offsets)
                head = np.frombuffer(b"".join(x[:8] for x in classes.to_pylist()), ">i8").astype(np.int64)
                # Equal sets have equal signatures: one of them speaks for all.
                _, only = np.unique(head, return_index=True)
                pick = np.zeros(len(head), bool)
                pick[only] = True
                who, key = signatures(sets, offsets, percent)
                mine = pick[who]
                nodes.append(head[who[mine]])
                keys.append(key[mine])
                size += int(mine.sum())
                if size >= flush:
                    yield pack(np.concatenate(nodes), np.concatenate(keys))
                    nodes, keys, size = [], [], 0
        if size:
            yield pack(np.concatenate(nodes), np.concatenate(keys))

    def meet(table: pa.Table) -> pa.Table:
        blob = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
        key = blob("high", np.uint8).astype(np.uint64) << np.uint64(32) | blob("low", np.uint32).astype(np.uint64)
        node = np.concatenate([_unpacked(x, len(y) // 4) for x, y in zip(table["node"].to_pylist(), table["low"].to_pylist())])
        order = np.lexsort((node, key))
        _, a, b = _linked(key[order], node[order])
        known = blob("edges", np.int64).reshape(-1, 2)
        a, b = _unique_edges(np.concatenate([a, known[:, 0]]), np.concatenate([b, known[:, 1]]))
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    packed = docs.select("text").mapInArrow(run, "shard int, low binary, high binary, node binary, edges binary")
    return packed.groupBy("shard").applyInArrow(meet, "a bigint, b bigint")


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = THRESHOLD, large: int = LARGE) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Words are split at white space and A-Z lower-cased.  Texts with fewer than ``words``
    words are one shingle; null, empty and blank texts have none, are linked with nothing
    and are their own component.  Repeated rows have equal sets and share a component.  A
    null doc_id is a component's id only if the component has no other.  Every input row
    gives one output row; extra columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    own = docs.select(*columns(docs, "doc_id", "text")).withColumn("th", F.xxhash64("text"))
    signed = scratch.write(sketched(own.select("doc_id", "th", "text"), words))
    head = F.conv(F.hex(F.substring("class", 1, 8)), 16, -10).cast("bigint").alias("f")
    full = signed.where("n_shingles > 0")
    elements = full.agg(F.sum("n_shingles").alias("n")).first()["n"] or 0
    edges = candidate_edges(own, max(1, -(-elements * 6 // 10 // SHARD)), words, percent)
    clusters = connected_components(edges).select("node", F.col("component").alias("cluster"))
    # One document of every class; sums and minima of a class are partial aggregates.
    classes = (full.groupBy("class").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("bits").alias("bits"),
        F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("k"), "doc_id", "th")).alias("one"))
        .select("class", head, "least", "n", "bits", "one"))
    classes = scratch.write(classes)
    members = scratch.write(classes.join(clusters, F.col("f") == F.col("node"))
                            .select("class", "node", "cluster", "one.doc_id", "one.th", "n", "bits"))
    sizes = scratch.write(members.groupBy("cluster").agg(F.sum("n").alias("tokens")).where(F.col("tokens") > large).select("cluster"))
    if not sizes.isEmpty():
        near = connected_components(split_clusters(members.join(sizes, "cluster"), percent))
        parts = members.drop("cluster").join(near.select("node", F.col("component").alias("cluster")), "node")
        members = scratch.write(members.join(sizes, "cluster", "left_anti").unionByName(parts.select(*members.columns)))
    found = scratch.write(link_classes(own, members, words, percent))
    parts = connected_components(found).withColumnsRenamed({"node": "class", "component": "_c"})
    named = classes.select("class", "least").join(parts, "class").groupBy("_c").agg(F.min("least").alias("component_id"))
    # Only classes with a link are here, one row each.
    placed = scratch.write(parts.join(named, "_c").select("class", F.col("component_id").alias("_linked"),
                                                          F.lit(True).alias("_found")))
    alone = classes.select("class", "least")
    every = scratch.write(alone.join(placed, "class", "left").select(
        "class", F.when(F.col("_found"), F.col("_linked")).otherwise(F.col("least")).alias("component_id")))
    blank = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return (full.select("doc_id", "n_shingles", "class").join(every, "class")
            .select("doc_id", "n_shingles", "component_id").unionAll(blank))


def jaccard_query(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs)
