"""Operator 3: near-duplicates by min-max hashing.

A document is its set of distinct 5-word shingles.  Every permutation gives two
signature values, its minimum and its maximum over the set, so a signature of
168 values costs 84 hash evaluations per shingle.  Bands of six values are the
bucket keys.  Documents with equal sets are one class from the start; the
buckets' connected components are candidate clusters; inside a cluster the full
sets are compared exactly, and the links found there are the result's edges.

A pair at similarity 0.85 misses all 28 bands with probability about 2e-6, and is
still compared when other copies join it to the same cluster.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.clusters import block_pairs, by_cluster, links, member_bits, only_members
from kestrel.llm.components import connected_components
from kestrel.llm.store import Scratch, columns
from kestrel.llm.text import fmix, hashes, spans, utf8

WORDS = 5
THRESHOLD = 85        # percent
BANDS, ROWS = 28, 6   # of the signature: (min, max) of BANDS * ROWS / 2 permutations


def shingle_sets(column, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, offsets per text).

    A text with fewer words is one shingle; one without words has none."""
    data, offsets = utf8(column)
    starts, ends = spans(data, offsets)
    h = hashes(data, starts, ends)
    n = len(offsets) - 1
    first = np.searchsorted(starts, offsets)          # first word of each text
    count = np.diff(first)
    window = np.maximum(count - words + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(n), window)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(window) - window, window) + first[:-1][doc]
    short = (count < words)[doc]
    out = np.zeros(len(doc), np.uint64)
    for k in range(words):
        inside = k < count[doc]
        term = h[np.minimum(at + k, max(len(h) - 1, 0))] * np.uint64(_ODD[k]) if len(h) else out
        out += np.where(inside, term, np.uint64(0))
    out = fmix(out ^ np.where(short, np.uint64(0x5BD1E995) + count[doc].astype(np.uint64), np.uint64(0)))
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    out, doc = out[keep], doc[keep]
    return out, np.searchsorted(doc, np.arange(n + 1))


def _constants(n: int, salt: int) -> np.ndarray:
    return fmix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


_ODD = [int(x) for x in _constants(16, 7)]


def min_max(values: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """(texts, n) signature: minimum and maximum of every text's set under n / 2
    permutations, so that each hash evaluation gives two signature values."""
    full = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, n), np.uint64)
    if len(full):
        at = offsets[:-1][full]
        mul, add = _constants(n // 2, 11), _constants(n // 2, 13)
        for i in range(n // 2):
            p = (values ^ add[i]) * mul[i]
            out[full, 2 * i] = np.minimum.reduceat(p, at)
            out[full, 2 * i + 1] = np.maximum.reduceat(p, at)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) keys; a band mixes minima and maxima of different permutations."""
    n = bands * rows
    # Value v of permutation v // 2: a stride deals the two of a permutation to different bands.
    order = np.concatenate([np.arange(0, n, 2), np.arange(1, n, 2)])
    picked = signature[:, order].reshape(len(signature), bands, rows)
    out = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        out = fmix(out * np.uint64(31) + picked[:, :, r])
    return out ^ _constants(bands, 17)[None, :]


def _fingerprints(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per set, as two words; zero for an empty one."""
    out = np.zeros((2, len(offsets) - 1), np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        for k in range(2):
            out[k, full] = fmix(np.add.reduceat(fmix(values ^ _constants(2, 19)[k]), offsets[:-1][full]))
    return out[0], out[1]


def class_key(values, offsets) -> pa.Array:
    a, b = _fingerprints(values, offsets)
    raw = np.stack([a, b], axis=1).astype(">u8").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(a), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _int64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def signatures(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``docs(doc_id, th, text)`` -> doc_id, th, n_shingles, class (of equal sets), bands."""
    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                sets, offsets = shingle_sets(part["text"], words)
                keys = band_keys(min_max(sets, offsets, bands * rows), bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * bands),
                                                 _int64(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["th"], pa.array(np.diff(offsets)), class_key(sets, offsets), lists],
                    names=["doc_id", "th", "n_shingles", "class", "bands"])
    return docs.mapInArrow(run, "doc_id bigint, th bigint, n_shingles bigint, class binary, bands array<bigint>")


def candidate_clusters(classes: DataFrame) -> DataFrame:
    """``classes(node, bands)`` -> (node, cluster): components over shared band keys.

    A bucket links each member to its smallest one, found by a partial aggregate,
    so a bucket of any size costs one row per member."""
    buckets = classes.select("node", F.explode("bands").alias("key"))
    heads = (buckets.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("_last"))
             .where("head != _last").drop("_last"))
    edges = buckets.join(heads, "key").where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    return connected_components(edges).select("node", F.col("component").alias("cluster"))


def link_classes(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Exact links (a, b) between classes; ``members(class, cluster, doc_id, th, n)`` names a
    document of every class, whose text gives the set."""
    def once(batches):
        # Repeated rows bring a class's text several times.
        known = set()
        for batch in batches:
            names = list(zip(batch["node"].to_pylist(), *(batch["task"].field(x).to_pylist() for x in "cij")))
            fresh = []
            for i, name in enumerate(names):
                if name not in known:
                    known.add(name)
                    fresh.append(i)
            yield batch.take(pa.array(fresh, pa.int64()))

    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        _, first = np.unique(np.array(table["node"].to_pylist(), object), return_index=True)
        table = table.take(pa.array(np.sort(first)))
        blobs = []
        for at in range(0, len(table), 500):
            values, offsets = shingle_sets(table["text"].slice(at, 500), words)
            blobs.append(pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 8).astype(np.int64).tobytes()),
                                                      pa.py_buffer(values.tobytes())]))
        table = table.select(["cluster", "node"]).append_column("set", pa.chunked_array(blobs, pa.large_binary()))
        out = []
        for some in by_cluster(table):
            node = some["node"].combine_chunks()
            found = np.array(links(some, percent), np.int64).reshape(-1, 2)
            out.append(pa.table({"a": node.take(pa.array(found[:, 0])), "b": node.take(pa.array(found[:, 1]))}))
        return pa.concat_tables(out)

    # Tasks are dealt on the narrow table. Then texts move, once to their class and once to each of its
    # tasks: packed they are half of their sets' hashes.
    sizes = members.groupBy("cluster").agg(F.sum("n").alias("tokens"))
    placed = block_pairs(members.select("cluster", F.col("class").alias("node"), F.col("doc_id").alias("_d"), F.col("th").alias("_t")),
                         sizes)
    texts = only_members(docs, member_bits(members)).join(
        placed, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")))
    wanted = texts.select("task", "cluster", "node", "text")
    return wanted.mapInArrow(once, wanted.schema).groupBy("task").applyInArrow(verify, "a binary, b binary")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = THRESHOLD,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, th (hash of the text), n_shingles, component_id, kept.

    Words are split at white space and A-Z lower-cased.  Texts with fewer than
    ``words`` words are one shingle; null, empty and blank texts have none and stand
    alone.  Repeated rows have equal sets, so they share a component, and all rows
    with its smallest doc_id are kept.  A null doc_id is never a component's id
    unless the component has no other.  Extra columns are ignored.
    """
    return _placed(docs, words, percent, bands, rows).drop("_c")


def _placed(docs: DataFrame, words: int = WORDS, percent: int = THRESHOLD,
            bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``near_duplicates`` plus ``_c``, the component's own key (null without words): a
    component_id is a doc_id, which unlinked texts may share."""
    scratch = Scratch(docs.sparkSession)
    own = docs.select(*columns(docs, "doc_id", "text")).withColumn("th", F.xxhash64("text"))
    signed = scratch.write(signatures(own.select("doc_id", "th", "text"), words, bands, rows))
    # One row per class of equal sets; f is 64 bits of it, enough for candidates.
    head = F.conv(F.hex(F.substring("class", 1, 8)), 16, -10).cast("bigint").alias("f")
    full = signed.where("n_shingles > 0")
    nodes = full.select(head, "bands").dropDuplicates(["f"]).select(F.col("f").alias("node"), "bands")
    clusters = candidate_clusters(nodes)
    classes = (full.select("class", head, "n_shingles", F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("k"),
                                                                 "doc_id", "th").alias("one"))
               .join(clusters, F.col("f") == F.col("node"))
               .groupBy("class", "cluster").agg(F.min("one").alias("one"), F.first("n_shingles").alias("n"))
               .select("class", "cluster", "one.doc_id", "one.th", "n"))
    members = scratch.write(classes)
    found = scratch.write(link_classes(own, members.where("n > 0"), words, percent))
    parts = connected_components(found).withColumnsRenamed({"node": "class", "component": "_c"})
    placed = signed.drop("bands").join(parts, "class", "left").withColumn(
        "_c", F.when(F.col("n_shingles") > 0, F.coalesce("_c", "class")))
    least = (placed.where("_c is not null").groupBy("_c").agg(F.min("doc_id").alias("_least")))
    return (placed.join(least, "_c", "left")
            .withColumn("component_id", F.when(F.col("_c").isNull(), F.col("doc_id")).otherwise(F.col("_least")))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select("doc_id", "th", "n_shingles", "component_id", "kept", "_c"))


def near_duplicate_stage(docs: DataFrame, **how) -> DataFrame:
    """One document of every near-duplicate group, with its own columns.

    Of repeated rows with the kept doc_id one stays; documents without words all stay.
    Unlinked texts with one doc_id, null included, are groups of their own."""
    verdicts = Scratch(docs.sparkSession).write(_placed(docs, **how))
    keep = verdicts.where("kept").groupBy("doc_id", "th", "_c").agg(
        F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("n_shingles"))
    # Rows of one (doc_id, text) are alike in what this operator reads; the first of them stays.
    one = (keep.where("n_shingles > 0").groupBy("_c").agg(F.min("th").alias("_t"), F.first("doc_id").alias("_d"),
                                                                  F.sum("n").alias("_n"))
           .select("_d", "_t", "_n", F.lit(False).alias("_blank"))
           .unionByName(keep.where("n_shingles = 0").select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"),
                                                             F.lit(1).cast("bigint").alias("_n"), F.lit(True).alias("_blank"))))
    doc = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), *columns(docs, "doc_id", "text"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_t"))
    joined = doc.join(one, same).select("_doc", "_d", "_t", "_n", "_blank")
    several = joined.where("_n > 1 AND NOT _blank").groupBy("_d", "_t").agg(F.first("_doc").alias("_doc"))
    return (joined.where("_n = 1 OR _blank").select("_doc")
            .unionByName(several.select("_doc")).select("_doc.*"))


def near_duplicate_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).drop("th")
