"""Operator 9: mixing sources to target weights.

Sources share 150 % of all words by their weights, each capped at twice its own
size.  A source first gives complete epochs of all its documents; the rest of
its target is a weighted sample without replacement (Efraimidis-Spirakis): every
document draws the exponential key ``-ln(u) / weight`` and the smallest keys are
taken until their prefix sum of words meets the budget.

No source is ever sorted whole.  Keys are summed into ``buckets`` key ranges per
source by a partial aggregate; the prefix sums over the ranges name the one range in
which the budget ends, which is cut into ``buckets`` finer ranges in the same way, and
only the finer range of the end is ordered by key.  The ranges follow the key's
distribution at three weights, so no weight puts more than about a thousandth of a
source into one.  What is left is one row per source, with the largest key that is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from kestrel.llm.store import Scratch, columns

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>!]"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2


def features(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """Per document: size (words), quality weight and exponential key.

    The quality weight falls from 1 by the symbols per word, down to 0.05.  ``u`` comes from the
    md5 of seed, doc_id and text, so reruns and retried tasks draw the same key; only rows that
    repeat both share it.
    """
    text = F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                                F.md5(text.cast("binary"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(16 ** 13))
    symbols = F.regexp_count(text, F.lit(SYMBOL))
    return (docs.withColumn("size", F.regexp_count(text, F.lit(WORD)).cast("bigint"))
            .withColumn("quality", F.when(F.col("size") > 0, F.greatest(F.lit(0.05), 1 - symbols / F.col("size")))
                        .otherwise(0.05))
            .withColumn("key", -F.log(u) / F.col("quality")))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = MAX_EPOCHS) -> DataFrame:
    """``sizes(source, source_size)`` -> plus ``target``: water-filling.

    Sources in code point order (null last) weigh ``weights``, repeating.  Sharing
    by weight with caps whose excess is reshared settles at one level: sorted by
    cap per weight, a source is capped when the level over the sources from it
    onward exceeds its cap.  One row per source, so the windows are small.
    """
    ordered = W.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1).cast("int"))
    by_level = W.orderBy("_ratio", F.col("source").asc_nulls_last())
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    leveled = (sizes.withColumn("_w", pick).withColumn("_cap", F.col("source_size") * float(cap))
               .withColumn("_ratio", F.col("_cap") / F.col("_w"))
               .withColumn("_left", F.sum("source_size").over(everything) * float(share)
                           - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
               .withColumn("_weights", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
               .withColumn("_level", F.col("_left") / F.col("_weights")))
    # The first source that its level does not fill sets the level for all that follow.
    level = F.min(F.when(F.col("_level") < F.col("_ratio"), F.struct("_ratio", "_level"))).over(everything)
    return (leveled.withColumn("_water", level["_level"])
            .withColumn("target", F.when(F.col("_water").isNull() | (F.col("_level") >= F.col("_ratio")), F.col("_cap"))
                        .otherwise(F.col("_w") * F.col("_water")))
            .select("source", "source_size", F.col("target").cast("double")))


def position(buckets: int) -> F.Column:
    """Place of a key among ``buckets`` squared ranges: a monotone map of the key to [0, 1), the mean
    of its distribution at the weights 1, 1/4 and 1/20."""
    spread = sum((1 - F.exp(F.col("key") * -w) for w in (1.0, 0.25, 0.05)), F.lit(0.0)) / 3
    return F.least(F.floor(spread * float(buckets ** 2)), F.lit(buckets ** 2 - 1)).cast("bigint")


def plan(narrow: DataFrame, buckets: int = 4096, **how) -> DataFrame:
    """``narrow(source, size, key, doc_id)`` -> one row per source: source_size, target,
    epochs, and ``cut`` = the last (key, doc_id) of the fractional epoch (null: none)."""
    spread = narrow.select("source", "size", F.struct("key", F.coalesce("doc_id", F.lit(-1)).alias("doc_id")).alias("o"),
                           position(buckets).alias("at"))
    coarse = F.floor(F.col("at") / buckets).cast("bigint")
    sums = spread.groupBy("source", coarse.alias("b")).agg(F.sum("size").alias("words"))
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    goal = (targets(sizes, **how)
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                        .otherwise(0).cast("int"))
            .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size"))))
    same = F.col("source").eqNullSafe(F.col("_s"))

    def end(ranges: DataFrame, known: DataFrame) -> DataFrame:
        """The range where the prefix sum reaches the rest: (_s, b, before, rest).  ``known``: (_s, start, rest)."""
        upto = F.col("start") + F.sum("words").over(W.partitionBy("source").orderBy("b"))
        return (ranges.join(known, same).withColumn("upto", upto)
                .where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")))
                .groupBy("source").agg(F.min(F.struct("b", (F.col("upto") - F.col("words")).alias("before"), "rest")).alias("e"))
                .select(F.col("source").alias("_s"), "e.b", "e.before", "e.rest"))

    first = end(sums, goal.select(F.col("source").alias("_s"), F.lit(0).cast("bigint").alias("start"), "rest"))
    inside = spread.join(first.withColumnsRenamed({"b": "_b", "before": "start"}), same & (coarse == F.col("_b")))
    fine = inside.groupBy("source", F.col("at").alias("b")).agg(F.sum("size").alias("words"))
    ends = end(fine, first.select("_s", F.col("before").alias("start"), "rest"))
    tail = (inside.select("source", "o", "size", "at").join(ends, same & (F.col("at") == F.col("b")))
            .groupBy("source", "o").agg(F.sum("size").alias("words"), F.first("before").alias("before"),
                                        F.first("rest").alias("rest")))
    upto = F.col("before") + F.sum("words").over(W.partitionBy("source").orderBy("o"))
    # A document is taken when that brings the sum nearer to the rest than stopping before it.
    taken = (tail.withColumn("upto", upto).where(F.col("upto") - F.col("rest") <= F.col("rest") - (F.col("upto") - F.col("words")))
             .groupBy("source").agg(F.max("o").alias("o")).select(F.col("source").alias("_s"), F.col("o").alias("in_range")))
    return (goal.join(ends.select("_s", F.col("b").alias("cut_bucket")), same, "left").drop("_s")
            .join(taken, same, "left").drop("_s", "rest"))


def taken(buckets: int = 4096) -> F.Column:
    """Words the mix takes of a document, given its columns and its source's plan."""
    b = position(buckets)
    order = F.struct("key", F.coalesce("doc_id", F.lit(-1)).alias("doc_id"))
    more = (b < F.col("cut_bucket")) | ((b == F.col("cut_bucket")) & (order <= F.col("in_range")))
    return (F.col("size") * (F.col("epochs") + F.when(more, 1).otherwise(0))).cast("bigint")


def mix(docs: DataFrame, seed: str = "mix", buckets: int = 4096, **how) -> DataFrame:
    """``docs(doc_id, text, source)`` -> one row per document: doc_id, size, source_size, target, taken.

    Null texts have size 0; null is a source of its own and comes last.  Rows with the
    same doc_id, text and source draw one key and are taken or left together.  An empty
    table gives an empty result; extra columns are ignored.
    """
    own = docs.select(*columns(docs, "doc_id", "text", "source"))
    scratch = Scratch(docs.sparkSession)
    narrow = scratch.write(features(own, seed).select("doc_id", "source", "size", "key"))
    # Written, its size is known before the join: one row per source is broadcast, many are shuffled.
    by_source = scratch.write(plan(narrow, buckets, **how).withColumnRenamed("source", "_s"))
    return (narrow.join(by_source, F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("taken", taken(buckets))
            .select("doc_id", "source", "size", "source_size", "target", "taken"))


def mix_stage(docs: DataFrame, seed: str = "mix", buckets: int = 4096, **how) -> DataFrame:
    """The mixed corpus: every document as many times as the mix takes it, with its own columns."""
    doc = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"),
                      *columns(docs, "doc_id", "text", "source"))
    scratch = Scratch(docs.sparkSession)
    narrow = scratch.write(features(doc, seed).select("doc_id", "source", "size", "key"))
    by_source = scratch.write(plan(narrow, buckets, **how).withColumnRenamed("source", "_s"))
    repeats = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    return (features(doc, seed).join(by_source, F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("taken", taken(buckets))
            .where("taken > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), repeats)))
            .select("_doc.*"))


def mix_query(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
