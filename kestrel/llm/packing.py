"""Operator 10: variable-capacity best-fit packing.

Documents are cut into pieces of at most the largest permitted sequence length
and dealt to shards of bounded size by a hash, so packing is one task per shard
and no document's copies crowd into one.  Within a shard pieces go in decreasing
length into the fullest bin that still holds them.  When none does, a bin of the
least cost per expected token is opened.  Every choice of the largest bin size is
tried and the cheapest packing kept; at last each bin shrinks to the smallest
permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.store import Scratch, columns

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 16            # tokens' worth of fixed cost per sequence
SHARD_PIECES = 8192      # pieces packed together
WORD = r"[^\x20\x09-\x0D]+"


def cost(capacity: int, overhead: int = OVERHEAD) -> int:
    """Cost of a bin: its slots plus a fixed part."""
    return capacity + overhead


def best_fit(lengths: np.ndarray, capacities, overhead: int = OVERHEAD) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Pack ``lengths`` (decreasing, each within the largest capacity).

    Returns the bin and the offset of every piece, and each bin's final capacity."""
    sizes = sorted(capacities)
    left = int(lengths.sum())
    room: dict[int, list[int]] = {}     # free space -> bins with it
    levels: list[int] = []              # the free spaces that occur, ascending
    used: list[int] = []
    full: list[int] = []
    where = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        at = bisect_left(levels, n)
        if at < len(levels):
            space = levels[at]
            b = room[space].pop()
            if not room[space]:
                del room[space]
                levels.pop(at)
        else:
            # Least cost per token it can be expected to hold; the smaller bin on a tie.
            space = min((c for c in sizes if c >= n), key=lambda c: (cost(c, overhead) / min(c, left), c))
            b = len(used)
            used.append(0)
            full.append(space)
        where[i], offset[i] = b, used[b]
        used[b] += n
        left -= n
        space -= n
        if space not in room:
            room[space] = []
            insort(levels, space)
        room[space].append(b)
    final = [sizes[bisect_left(sizes, u)] for u in used]
    return where, offset, final


def pack_jointly(lengths: np.ndarray, capacities=CAPACITIES, overhead: int = OVERHEAD):
    """The cheapest best-fit packing over the choices of the largest bin size to open."""
    sizes = sorted(capacities)
    best = None
    for top in range(bisect_left(sizes, int(lengths[0])), len(sizes)):
        packed = best_fit(lengths, sizes[:top + 1], overhead)
        total = sum(cost(c, overhead) for c in packed[2])
        if best is None or total < best[0]:
            best = (total, packed)
    return best[1]


def pieces(items: DataFrame, longest: int) -> DataFrame:
    """``items(row, doc_id, n)`` -> one row per piece: row, doc_id, piece, start, length."""
    count = F.ceil(F.col("n") / F.lit(longest)).cast("int")
    return (items.where("n > 0").withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
            .withColumn("start", (F.col("piece") * F.lit(longest)).cast("bigint"))
            .select("row", "doc_id", "piece", "start",
                    F.least(F.lit(longest).cast("bigint"), F.col("n") - F.col("start")).alias("length")))


def pack(docs: DataFrame, capacities=CAPACITIES, overhead: int = OVERHEAD, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per piece: doc_id, row (which input row), piece, start,
    length, bin_id, offset (within the bin), capacity (of the bin).

    Lengths are words (split at white space).  Pieces of one document cover it from
    start to end; nothing is dropped or cut short.  A document without words (null,
    empty or blank text) has one row of length 0 and no bin.  Repeated rows are packed
    each, told apart by ``row``.  Extra columns are ignored; an empty table packs to none.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    own = docs.select(*columns(docs, "doc_id", "text"))
    # Written once: the row numbers below must not depend on a recomputed scan.
    items = scratch.write(own.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint").alias("n")))
    cut = pieces(items, max(capacities))
    total = items.agg(F.sum(F.ceil(F.col("n") / F.lit(max(capacities)))).cast("bigint").alias("n")).first()["n"] or 0
    shards = max(1, -(-total // shard_pieces))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("row", "ascending"), ("piece", "ascending")])
        where, offset, final = pack_jointly(table["length"].to_numpy(), capacities, overhead)
        shard = table["shard"][0].as_py()
        return table.drop_columns(["shard"]).append_column("bin_id", pa.array((shard << 32) + where)).append_column(
            "offset", pa.array(offset)).append_column("capacity", pa.array(np.array(final, np.int64)[where]))

    schema = ("row bigint, doc_id bigint, piece int, start bigint, length bigint, "
              "bin_id bigint, offset bigint, capacity bigint")
    packed = (cut.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("bigint"))
              .groupBy("shard").applyInArrow(run, schema))
    empty = items.where("n = 0").selectExpr(
        "row", "doc_id", "0 AS piece", "CAST(0 AS BIGINT) AS start", "CAST(0 AS BIGINT) AS length",
        "CAST(NULL AS BIGINT) AS bin_id", "CAST(NULL AS BIGINT) AS offset", "CAST(NULL AS BIGINT) AS capacity")
    return packed.unionByName(empty)


def pack_query(docs: DataFrame) -> DataFrame:
    return pack(docs)
