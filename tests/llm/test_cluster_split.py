"""Large candidate clusters are split by bit maps before whole sets meet (op13), and texts, not sets, travel (op3, op13)."""

import random

import numpy as np
from pyspark.sql import functions as F

from kestrel.llm import minhash, partenum
from tests.llm import brute
from tests.llm.test_runs_trees_joins import frame


def some_sets(seed, n=60):
    """Sets of 1 to 400 elements, a third of them a near copy of an earlier one."""
    rng = random.Random(seed)
    sets = []
    for _ in range(n):
        if sets and rng.random() < 0.35:
            base = list(rng.choice(sets))
            keep = base[rng.randrange(1 + len(base) // 8):]
            sets.append(set(keep) | {rng.getrandbits(64) for _ in range(rng.randrange(1 + len(base) // 8))} or {1})
        else:
            sets.append({rng.getrandbits(64) for _ in range(rng.choice([1, 3, 20, 63, 64, 65, 130, 400]))})
    return [np.array(sorted(s), np.uint64) for s in sets]


def similar(a, b, percent):
    both = len(np.intersect1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


def connected(n, pairs):
    label = list(range(n))
    for a, b in pairs:
        old, new = label[a], label[b]
        label = [new if x == old else x for x in label]
    return label


def mapped(sets):
    return partenum.bit_maps(np.concatenate(sets), np.append(0, np.cumsum([len(s) for s in sets])))


def test_bit_maps_never_part_similar_sets_and_part_others(spark):
    for seed in range(4):
        sets = some_sets(seed)
        n = np.array([len(s) for s in sets])
        rows = [(1, i, int(n[i]), b) for i, b in enumerate(mapped(sets).to_pylist())]
        members = spark.createDataFrame(rows, "cluster bigint, node bigint, n bigint, bits binary")
        for nodes in (1 << 15, 7):      # one block, and pairs of blocks
            got = connected(len(sets), [tuple(r) for r in partenum.split_clusters(members, 85, nodes).collect()])
            for a in range(len(sets)):
                for b in range(a):
                    assert not similar(sets[a], sets[b], 85) or got[a] == got[b]
        big = np.flatnonzero(n >= 130)
        loose = [(a, b) for a in big for b in big if a < b and not len(np.intersect1d(sets[a], sets[b]))]
        assert sum(got[a] != got[b] for a, b in loose) == len(loose)


def test_groups_do_not_mix():
    same = [b"\x01" + b"\x00" * 7] * 4
    assert sorted(partenum.near_pairs(np.array([5, 6, 5, 6]), np.array([1, 1, 1, 1]), same, 85)) == [(0, 2), (1, 3)]


def test_split_components_match_brute_force(spark):
    rng = random.Random(5)
    docs = []
    for i in range(120):
        if i % 3 and docs:
            text = rng.choice(docs)[1].split()
            text[rng.randrange(len(text))] = f"x{i}"
            docs.append((i, " ".join(text)))
        else:
            docs.append((i, " ".join(rng.choice("abcdefghij") + rng.choice("klm") for _ in range(rng.choice([5, 40, 200])))))
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in partenum.jaccard_components(frame(spark, docs), large=0).collect()}
    assert got == brute.jaccard_components(docs)


def test_texts_of_members_are_not_turned_into_sets_before_they_travel(spark):
    docs = frame(spark, [(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (1, "a b c d e f g h")]).withColumn("th", F.xxhash64("text"))
    members = docs.distinct().select(F.col("doc_id").cast("string").cast("binary").alias("class"), F.lit(1).cast("bigint").alias("cluster"),
                                     "doc_id", "th", F.lit(5).cast("bigint").alias("n"))
    found = minhash.link_classes(docs, members, 4, 80)
    assert [sorted((bytes(r.a), bytes(r.b))) for r in found.collect()] == [[b"1", b"2"]]
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "set#" not in plan and "text#" in plan


def test_packed_numbers_come_back():
    for n in (0, 1, 2, 5000):
        x = np.sort(np.random.default_rng(n).integers(-2 ** 63, 2 ** 63 - 1, n))
        x[:n // 3] = x[n // 3] if n else x[:0]
        assert (partenum._unpacked(partenum._packed(x), n) == x).all()
    assert len(partenum._packed(x)) < 7 * n
