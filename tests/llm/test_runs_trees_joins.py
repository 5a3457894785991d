"""Operators 11, 12 and 13 against brute force, and their edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from kestrel.llm import covertree, partenum, runs
from kestrel.llm.catalog import QUERIES
from kestrel.llm.text import fmix
from tests.llm import brute
from tests.llm.test_operators import EDGE, SMALL, frame, prose


# ------------------------------------------------------------------ 11 periodic runs
def random_words(r):
    n, k = r.randrange(0, 90), r.choice([1, 2, 3, 5, 20])
    w = [r.randrange(k) for _ in range(n)]
    for _ in range(r.randrange(0, 3)):
        if n > 10:
            a, p = r.randrange(n), r.randrange(1, 9)
            for i in range(min(n - a, p * r.randrange(3, 9) + r.randrange(p))):
                w[a + i] = w[a + i % p]
    return w


def test_runs_match_brute_force():
    r = random.Random(11)
    for _ in range(400):
        docs = [random_words(r) for _ in range(r.randrange(1, 5))]
        word = fmix(np.array([x for d in docs for x in d], dtype=np.uint64) + np.uint64(5))
        doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        assert runs.find_runs(word, doc) == [(d, *x) for d, w in enumerate(docs) for x in brute.runs(w)]


def test_runs_of_long_and_flat_texts():
    one = np.zeros(100_000, np.uint64)
    assert runs.find_runs(one, np.zeros(len(one), int)) == [(0, 0, 100_000, 1)]
    two = fmix(np.arange(60_000, dtype=np.uint64) % np.uint64(777))
    assert runs.find_runs(two, np.zeros(len(two), int)) == [(0, 60_000, 777)] or \
        runs.find_runs(two, np.zeros(len(two), int)) == [(0, 0, 60_000, 777)]
    # A square-free middle between two runs, and a run inside a run's period.
    w = brute.words("a b " * 5 + "c d e f g " + "x x x x x x y " * 4)
    number = {v: i for i, v in enumerate(w)}
    got = runs.find_runs(fmix(np.array([number[x] for x in w], np.uint64)), np.zeros(len(w), int))
    assert [g[1:] for g in got] == brute.runs(w) and len(got) == 6


def expected_runs(doc_id, text):
    w = brute.words(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = brute.runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    s, n, q = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(found), s, n, q, 1000 * n // q if found else None, digest("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            digest(" ".join(x for i, x in enumerate(w) if i not in gone)))


def runs_rows(df):
    return [(r.doc_id, (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256))
            for r in df.collect()]


def test_runs_query_on_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = dict(runs_rows(QUERIES["op11_periodic_runs"](spark, SMALL)))
    assert got == {d: expected_runs(d, t) for d, t in docs}
    assert sum(x[0] > 0 for x in got.values()) > 5


def test_runs_edges(spark):
    planted = [d for d in range(2000) if zlib.crc32(str(d).encode()) % 10 == 0][:3]
    rows = [(d, t if d != 7 else "word " * 2_000) for d, t in EDGE] + [(planted[0], None), (planted[1], "w " * 500), (planted[2], "one two three four"), (1, "a A a A a A a A"),
                   (1, "a a a a a a"), (1, "a a a a a a"), (None, "b\tb\nb b\rb\x0bb"), (77, "x x x x y y")]
    got = runs_rows(runs.runs_query(frame(spark, rows)))
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1]))
    assert sorted(got, key=key) == sorted([(d, expected_runs(d, t)) for d, t in rows], key=key)
    clash = frame(spark, [(5, "z z z z z z z", 1, "k", 2)], "doc_id bigint, text string, runs int, collapsed string, _h int")
    row = runs.periodic_runs(clash).first()
    assert (row.n_words, row.collapsed, [tuple(x) for x in row.runs]) == (7, "z", [(0, 7, 1)])
    assert runs.runs_query(clash).count() == 1
    assert runs.runs_query(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ 12 hard negatives
def clustered(n, dims, seed, spread=40):
    r = random.Random(seed)
    centres = [[r.randrange(-200, 200) for _ in range(dims)] for _ in range(12)]
    return [(i, r.randrange(4), [c + r.randrange(-spread, spread + 1) for c in centres[i % 12]]) for i in range(n)]


VECTORS = "vec_id bigint, label bigint, vec array<bigint>"


@pytest.mark.parametrize("how", [{}, {"pivots": 5, "sample_rows": 40, "block_rows": 90, "query_rows": 2}])
def test_hard_negatives_match_brute_force(spark, how):
    rows = clustered(1200, 6, 3)
    data = frame(spark, rows, VECTORS)
    got = covertree.hard_negatives(data.where("vec_id % 100 = 0"), data, **how).collect()
    assert {tuple(r) for r in got} == brute.hard_negatives(rows) and len(got) > 200


def test_cover_tree_invariants():
    x = np.array([r[2] for r in clustered(3000, 8, 5)] + [[7] * 8] * 100)
    largest = float(np.sqrt((x ** 2).sum(axis=1).max()))
    points = covertree.augmented(x, largest)
    assert np.allclose(np.sqrt((points ** 2).sum(axis=1)), largest)
    tree = covertree.CoverTree(points)
    assert sorted(np.concatenate(tree.members).tolist()) == list(range(len(x)))
    for (level, node), some in zip(tree.leaves, tree.members):
        while level >= 0:
            centre, radius, parent = (v[node] for v in tree.levels[level])
            assert np.sqrt(((points[some] - points[centre]) ** 2).sum(axis=1)).max() <= radius + 1e-9
            level, node = level - 1, parent
    # Bounds hold for every point below a node.
    q = np.array([r[2] for r in clustered(20, 8, 9)])
    length = np.sqrt((q.astype(float) ** 2).sum(axis=1))
    for centre, radius, _ in tree.levels:
        low, high = covertree.score_bounds((q @ x[centre].T).astype(float), length, radius, largest)
        for i, c in enumerate(centre):
            near = np.sqrt(((points - points[c]) ** 2).sum(axis=1)) <= radius[i]
            s = q @ x[near].T
            assert (s >= low[:, i:i + 1]).all() and (s <= high[:, i:i + 1]).all()


def test_cover_tree_skips(spark):
    """On clustered data a search verifies a part of the points only, and loses nothing."""
    rows = clustered(4000, 8, 6, spread=6)
    x, labels = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])
    ids, largest = np.arange(4000), float(np.sqrt((x ** 2).sum(axis=1).max()))
    search = covertree.Search(x, ids, labels, largest)
    q = x[:3]
    low, high = np.array([20_000, 0, -covertree.ANY]), np.array([60_000, 100, covertree.ANY])
    bound = search._leaf_bounds(q, np.arange(3), low, high)
    assert (bound[:2] > -np.inf).mean() < 0.7
    window, best, found = search.run(q, ids[:3], labels[:3], np.arange(3), low, high, 5, False)
    for i in range(3):
        s = x @ q[i]
        fit = [(-int(s[j]), j) for j in range(4000) if j != i and labels[j] != labels[i] and low[i] <= s[j] <= high[i]]
        assert list(zip((-best[window == i]).tolist(), found[window == i].tolist())) == sorted(fit)[:5]


def test_hard_negatives_small_and_odd(spark):
    assert covertree.hard_negatives(frame(spark, [], VECTORS), frame(spark, [], VECTORS)).count() == 0
    same = [(i, i % 2, [3, 4]) for i in range(0, 400, 10)]
    got = covertree.hard_negatives(frame(spark, same, VECTORS), frame(spark, same, VECTORS))
    assert got.count() == 0                                   # equal scores lie outside 30 to 90 percent
    zero = [(0, 1, [0, 0]), (1, 1, [5, 5]), (2, 2, [1, 1]), (3, 2, [0, 0])]
    got = covertree.hard_negatives(frame(spark, zero[:1], VECTORS), frame(spark, zero, VECTORS)).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 0, 0), (0, 1, 2, 3, 0, 0)]
    tied = [(0, 1, [10, 0]), (7, 1, [10, 0]), (9, 2, [5, 9]), (5, 2, [5, 1]), (6, 3, [5])]
    got = covertree.hard_negatives(frame(spark, tied[:1] * 2, VECTORS), frame(spark, tied + tied[2:3], VECTORS)).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: r.rank)] == [
        (0, 7, 1, 5, 100, 50), (0, 7, 2, 6, 100, 50), (0, 7, 3, 9, 100, 50), (0, 7, 4, 9, 100, 50)]


def test_hard_negatives_query_drops_unfit_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0], 3), (101, [1.0, 0.0], 3), (102, [0.5, 0.0], 4), (103, None, 4), (104, [nan, 1.0], 4),
            (105, [0.5, inf], 4), (106, [0.5, None], 4), (107, [0.5, 0.0], None), (None, [0.5, 0.0], 4), (112, [0.5, 0.1], 9)]
    table = spark.createDataFrame([(*r, 0, "x") for r in rows],
                                  "vec_id bigint, embedding array<float>, label int, score int, cell string")
    got = sorted(tuple(r) for r in covertree.negatives_query(table).collect())
    assert got == [(100, 101, 1, 102, 65536, 32768), (100, 101, 2, 112, 65536, 32768)]


# ------------------------------------------------------------------ 13 n-gram join
def test_signatures_lose_no_pair():
    r = random.Random(2)
    seen = 0
    for _ in range(1200):
        size = r.choice([1, 3, 6, 8, 12, 20, 33, 60, 100, 300, 900])
        a = [r.getrandbits(62) for _ in range(size)]
        b = a[r.randrange(0, max(1, int(.17 * size)) + 1):] + [
            r.getrandbits(62) for _ in range(r.randrange(0, max(1, int(.18 * size)) + 1))]
        both = len(set(a) & set(b))
        if not b or set(a) == set(b) or 100 * both < 85 * (len(a) + len(b) - both):
            continue
        values = np.concatenate([np.sort(np.array(x, np.uint64)) for x in (a, b)])
        who, key = partenum.signatures(values, np.array([0, len(a), len(a) + len(b)]))
        assert set(key[who == 0].tolist()) & set(key[who == 1].tolist())
        seen += 1
    assert seen > 300


def test_empty_signatures_are_rare():
    r = np.random.default_rng(4)
    values = np.sort(r.integers(1, 2 ** 62, (400, 500)).astype(np.uint64), axis=1).ravel()
    who, key = partenum.signatures(values, np.arange(401) * 500)
    assert len(np.unique(key)) == len(key)                    # unrelated sets share nothing
    assert len(key) / len(values) < 0.7


def near_texts(seed):
    r = random.Random(seed)
    docs = []
    for g in range(25):
        base = prose(r.choice([6, 12, 30, 80, 200]), seed * 100 + g, 3000)
        for copy in range(6):
            text = list(base)
            for _ in range(r.randrange(0, max(2, len(base) // 18))):
                text[r.randrange(len(text))] = f"new{r.randrange(10 ** 6)}"
            docs.append((g * 6 + copy, " ".join(text)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_matches_brute_force(spark, seed):
    docs = near_texts(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in partenum.jaccard_components(frame(spark, docs)).collect()}
    want = brute.jaccard_components(docs)
    assert got == want and len({c for _, c in want.values()}) < len(docs)


def test_jaccard_join_shards_and_flushes(spark, monkeypatch):
    docs = near_texts(3)
    monkeypatch.setattr(partenum, "SHARD", 300)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in partenum.jaccard_components(frame(spark, docs).repartition(7)).collect()}
    assert got == brute.jaccard_components(docs)
    own = frame(spark, docs)
    few = {tuple(r) for r in partenum.candidate_edges(own, 3, flush=50).collect()}
    assert few and all(a != b for a, b in few)


def test_jaccard_join_edges(spark):
    rows = EDGE + [(20, "one two three four"), (21, "ONE two three FOUR"), (19, "one  two\nthree\tfour"), (None, "alone and unlinked here now"),
                   (30, "five words are in here"), (30, "five words are in here"), (None, "five words are in here")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in partenum.jaccard_components(frame(spark, rows)).collect()),
                 key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7), (None, 3, None), (8, 3, 8),
                          (20, 1, 19), (21, 1, 19), (19, 1, 19), (None, 2, None), (30, 2, 30), (30, 2, 30), (None, 2, 30)], key=str)
    clash = frame(spark, [(1, "a b c d e", 1, b"x"), (2, "a b c d e", 2, None)], "doc_id bigint, text string, th int, class binary")
    assert {tuple(r) for r in partenum.jaccard_components(clash).collect()} == {(1, 2, 1), (2, 2, 1)}
    assert partenum.jaccard_components(frame(spark, [])).count() == 0
