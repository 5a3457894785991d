import importlib

import pytest

from tests.llm import brute
from tests.llm.test_operators import DOC, check_packing, frame, prose, water

ROOT_QUERIES = ["pipeline"] + [f"op{n}_" for n in range(1, 14)]


def test_queries_registered():
    import importlib.util
    import os
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(root, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    names = list(mod.queries())
    assert all(sum(n.startswith(q) for n in names) == 1 for q in ROOT_QUERIES if q != "op1_")
    assert set(mod.oracle_sql()) <= set(names)


def documents():
    rows = []
    for g in range(20):
        base = prose(120 + g, g, 5000)
        for copy in range(3):
            text = list(base)
            text[5 + copy] = f"changed{copy}"
            rows.append((10 * g + copy, "\n".join(" ".join(text[i:i + 40]) for i in range(0, len(text), 40)), "en",
                         "ab"[g % 2], 0))
    rows += [(900, "spam " * 80, "en", "a", 0), (901, None, None, None, None), (902, "", None, "a", 0),
             (903, "few words", None, "a", 0)]
    return rows


def test_pipeline_against_brute_force(spark, tmp_path):
    """Each stage of run() is held against the plain version on its own input."""
    pipeline = importlib.import_module("corpus_pipeline")
    docs = frame(spark, documents(), DOC)
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "minhash_dedup", "source_mixing", "best_fit_packing"]
    seen = {}
    now = docs
    for name, stage in pipeline.STAGES:
        out = stage(spark, now, None)
        path = str(tmp_path / name)
        out.write.parquet(path)
        seen[name] = (now.collect(), spark.read.parquet(path))
        if name != names[-1]:
            assert out.columns == docs.columns
        now = spark.read.parquet(path)
    given, out = seen["quality_rules"]
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in given if r.doc_id < 900}
    given, out = seen["line_dedup"]
    gone = brute.line_removals([(r.doc_id, r.text) for r in given])
    want = {}
    for r in given:
        text = "\n".join(x for i, x in enumerate(r.text.split("\n")) if i not in gone[r.doc_id])
        if brute.words(text) or not gone[r.doc_id]:
            want[r.doc_id] = text
    assert {r.doc_id: r.text for r in out.collect()} == want
    given, out = seen["minhash_dedup"]
    parts = brute.near_duplicates([(r.doc_id, r.text) for r in given])
    assert {r.doc_id for r in out.collect()} == {c for _, c in parts.values()}
    given, out = seen["source_mixing"]
    sizes = {}
    for r in given:
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.words(r.text))
    for s, target in water(sizes).items():
        got = sum(len(brute.words(r.text)) for r in out.collect() if r.source == s)
        assert abs(got - target) <= max(len(brute.words(r.text)) for r in given if r.source == s)
    given, out = seen["best_fit_packing"]
    check_packing(out.collect(), [(r.doc_id, r.text) for r in given], (512, 1024, 2048, 4096))


def test_near_duplicate_stage_at_80_percent(spark):
    """Three far-apart substitutions in 180 words leave a similarity of 0.80 to 0.85."""
    import corpus_pipeline
    rows = []
    for g in range(12):
        base = prose(180, 700 + g, 5000)
        for copy in range(2):
            text = list(base)
            for k in range((3 + g % 2) * copy):
                text[20 + 40 * k] = f"new{g}x{k}"
            rows.append((10 * g + copy, " ".join(text), "en", "a", 0))
    got = {r.doc_id for r in corpus_pipeline.minhash_dedup(spark, frame(spark, rows, DOC), None).collect()}
    docs = [(r[0], r[1]) for r in rows]
    want = {c for _, c in brute.near_duplicates(docs, 80).values()}
    assert got == want
    assert len(want) < len({c for _, c in brute.near_duplicates(docs, 85).values()})


def test_run_on_documents(spark):
    import corpus_pipeline
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.bin_id is not None for r in rows)
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("n", [0])
def test_empty_pipeline(spark, n):
    import corpus_pipeline
    now = frame(spark, documents(), DOC).limit(n)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, None)
    assert now.count() == 0
