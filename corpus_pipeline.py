"""A training corpus from ``documents``: quality rules, line dedup, near-duplicate removal,
mixing to source weights, and packing into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet in the shared checkpoint folder and reads it as the next one's
input.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import linededup, minhash, mixing, packing, quality
from kestrel.llm.store import Scratch
from kestrel.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that a rule rejects go."""
    return quality.quality_stage(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: repeated lines are cut out of the texts; a document left without words goes."""
    return linededup.line_stage(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each near-duplicate group stays.

    Pairs count from similarity 0.8 on; one at 0.8 misses all 48 bands with probability about 5e-7."""
    return minhash.near_duplicate_stage(docs, percent=80, bands=48)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: every document as often as the mix takes it."""
    return mixing.mix_stage(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the pieces of the documents with their place in the sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Min-max signatures and best-fit packing cannot be said in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs
