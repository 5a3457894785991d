"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import (covertree, html, knn, langid, licenses, linededup, minhash, mixing, packing,
                          partenum, quality, runs, urls)
from kestrel.llm.sql import ORACLE
from kestrel.sources.tables import table


def _over(name: str, f: Callable[[DataFrame], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(table(spark, sf_dir, name))
    run.__doc__ = f.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": _over("pages", urls.url_verdicts),
    "op2_html_extract": _over("pages", html.extract_query),
    "op3_minhash_dedup": _over("documents", minhash.near_duplicate_query),
    "op4_line_dedup": _over("documents", linededup.line_query),
    "op5_quality_rules": _over("documents", quality.quality_query),
    "op6_license_scan": _over("documents", licenses.licence_query),
    "op7_topk_search": _over("embeddings", knn.knn_query),
    "op8_language_id": _over("documents", langid.language_query),
    "op9_source_mixing": _over("documents", mixing.mix_query),
    "op10_best_fit_packing": _over("documents", packing.pack_query),
    "op11_periodic_runs": _over("documents", runs.runs_query),
    "op12_hard_negatives": _over("embeddings", covertree.negatives_query),
    "op13_ngram_jaccard_join": _over("documents", partenum.jaccard_query),
}

__all__ = ["ORACLE", "QUERIES"]
