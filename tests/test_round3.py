"""k-core by degrees, genre matching linear in the token, the wide training schema."""

import random
import time

import pytest

from kestrel import session
from kestrel.catalog import GENRES, RANK_FEATURES
from kestrel.operators import features as feat
from kestrel.operators import prep


def core(rows, min_user, min_item):
    while True:
        users, items = {}, {}
        for u, i, _ in rows:
            users[u] = users.get(u, 0) + 1
        kept = [r for r in rows if users[r[0]] >= min_user]
        for _, i, _ in kept:
            items[i] = items.get(i, 0) + 1
        kept = [r for r in kept if items[r[1]] >= min_item]
        if len(kept) == len(rows):
            return sorted(kept)
        rows = kept


@pytest.mark.parametrize("seed,least", [(1, (3, 4)), (2, (2, 2))])
def test_k_core_peels_to_the_fixpoint(spark, monkeypatch, seed, least):
    r = random.Random(seed)
    # Sparse enough that removals go on for several passes, with repeated pairs and a hot user.
    rows = [(int(40 * r.random() ** 2), int(60 * r.random() ** 2), n) for n in range(260)] + [(0, i % 9, 1000 + i) for i in range(90)]
    rows += [(100 + i, 200 + i + d, 2000 + 2 * i + d) for i in range(8) for d in (0, 1)]  # a chain, peeled from its ends
    written = []
    monkeypatch.setattr(prep, "cut_lineage", lambda df: written.append(session.cut_lineage(df)) or written[-1])
    got = prep.k_core(spark.createDataFrame(rows, "user_id long, item_id long, n long"), *least)
    assert sorted(tuple(x) for x in got.collect()) == core(rows, *least)
    # Only the result is left of all tables written.
    assert [x._cut_path is not None for x in written] == [False] * (len(written) - 1) + [True]


def test_k_core_without_removals_writes_once(spark):
    df = spark.createDataFrame([(u, i) for u in range(3) for i in range(3)], "user_id long, item_id long")
    assert prep.k_core(df, 2, 2).count() == 9
    assert prep.k_core(df.limit(0), 2, 2).count() == 0


def test_genres_equal_the_substring_test(spark):
    r = random.Random(7)
    tokens = ["".join(r.choice("ab") for _ in range(r.randrange(1, 9))) for _ in range(25)]
    tokens += ["x" * 40, "yy" + "x" * 45 + "z", "x" * 39 + "q", "(no genres listed)", "é ü", "a é üb"]
    rows = [(i, "t", "|".join(r.sample(tokens, r.randrange(1, 4)))) for i in range(120)] + [(500, "t", None), (501, "t", "")]
    got = {tuple(x) for x in feat.item_genres_long(spark.createDataFrame(rows, "item_id long, title string, genres string")).collect()}
    names = {t for _, _, g in rows if g for t in g.split("|")} - {"(no genres listed)", ""}
    assert got == {(i, n) for i, _, g in rows if g for n in names if any(n in t for t in g.split("|"))}


def test_genres_of_a_very_long_token(spark):
    long = "z" * 99_990 + "Drama" + "zzzzz"
    rows = [(1, "t", f"Drama|{long}"), (2, "t", "Drama"), (3, "t", "Sci-Fi"), (4, "t", long)]
    df = spark.createDataFrame(rows, "item_id long, title string, genres string")
    feat.item_genres_long(df.where("item_id = 2")).collect()
    start = time.time()
    got = sorted((x.item_id, x.genre[:6]) for x in feat.item_genres_long(df).collect())
    assert time.time() - start < 20
    assert got == [(1, "Drama"), (1, "zzzzzz"), (2, "Drama"), (3, "Sci-Fi"), (4, "Drama"), (4, "zzzzzz")]


def test_wide_genres_follow_the_declared_vocabulary(spark):
    df = spark.createDataFrame([(1, "t", "Sci-Fi|Film Noir"), (2, "t", "Other")], "item_id long, title string, genres string")
    out = feat.genre_wide(feat.item_genres_long(df), ["Film Noir", "Sci-Fi", "War"])
    assert out.columns == ["item_id", "genre_Film_Noir", "genre_Sci_Fi", "genre_War"]
    assert sorted(tuple(x) for x in out.collect()) == [(1, 1, 1, 0), (2, 0, 0, 0)]
    assert len(RANK_FEATURES) == 45 == len(set(RANK_FEATURES)) and len(GENRES) == 19
