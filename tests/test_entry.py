import importlib.util
import os

import pytest

from tests.oracle_check import compare, duck

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL = "/root/testdata/sf0.001"


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    df = _entry().entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and {r["k"] for r in rows} == {5, 10, 20}


def test_oracle_keys_subset_of_queries():
    m = _entry()
    assert set(m.oracle_sql()) <= set(m.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")
@pytest.mark.parametrize("name", ["popularity_eval", "user_features_full", "pit_join", "vector_topk", "ab_report",
                                  "latency_sla", "negatives_uniform", "title_suggest", "stream_bandit", "candidate_set",
                                  "stream_sessions", "stream_attribution", "psi_skew", "negatives_popularity",
                                  "store_matrix", "explode_positives", "full_ranking_eval", "ab_session_conversion"])
def test_query_matches_oracle_small(spark, name):
    m = _entry()
    s = m.queries()[name](spark, SMALL).toPandas()
    ok, msg = compare(s, duck(m.oracle_sql()[name], SMALL))
    assert ok, msg
