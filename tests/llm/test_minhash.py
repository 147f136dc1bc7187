import random

import pytest

from loamline.llm import minhash as M
from loamline.llm import queries


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(zip(*(words[i:] for i in range(k)))) if len(words) >= k else frozenset([tuple(words)])


def brute(rows, k, percent=80):
    """component of every id by comparing all pairs."""
    sets = {}
    for i, t in rows:
        sets.setdefault(i, shingles(t, k))
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and 100 * small >= percent * large:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (small + large - both):
                    x, y = top(a), top(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def as_dict(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_query_against_all_pairs(spark, sf, corpus):
    assert as_dict(queries.op9_near_duplicates(spark, sf)) == brute(corpus, 2)


@pytest.mark.parametrize(("block", "block_shingles", "kind"), [(512, 10**6, "long"), (8, 10**6, "long"), (512, 500, "string")])
def test_families_of_uneven_copies(spark, block, block_shingles, kind):
    """Groups whose least member is far from the others, so links run through other members; small blocks, ids as text."""
    random.seed(6)
    rows, n = [], 0
    for _ in range(6):
        base = [f"w{random.randrange(10**6)}" for _ in range(60)]
        for _ in range(15):
            copy = list(base)
            for _ in range(random.choice([0, 1, 2, 3, 4, 6])):
                copy[random.randrange(60)] = f"x{random.randrange(10**6)}"
            rows.append((n, " ".join(copy)))
            n += 1
    ids = list(range(n))
    random.shuffle(ids)
    rows = [(ids[i] if kind == "long" else f"{ids[i]:03d}", t) for i, t in rows]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    assert as_dict(M.near_duplicates(df, M.Settings(shingle=2, block=block, block_shingles=block_shingles))) == brute(rows, 2)


def test_components_by_stars(spark):
    random.seed(9)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    parent = {}

    def top(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in M.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: top(i) for i in list(parent) if top(i) != i}


def test_odd_rows(odd, none):
    rows = M.near_duplicates(odd, M.Settings(shingle=2)).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[2].n_shingles == by[3].n_shingles == by[8].n_shingles == 0 and by[2].component_id == 2 and by[3].kept
    assert by[4].component_id == 1 and by[5].n_shingles == 1 and by[None].kept is False
    assert sum(r.doc_id == 4 for r in rows) == 2
    assert M.near_duplicates(none).count() == 0


def test_short_texts_are_one_shingle(spark):
    df = spark.createDataFrame([(1, "One two"), (2, "one  TWO"), (3, "two one"), (4, "x"), (5, "x"), (6, "É x"), (7, "é x")], "doc_id long, text string")
    got = as_dict(M.near_duplicates(df, M.Settings(shingle=5)))
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 7)}


def test_drop_keeps_one_of_each(spark, odd, none):
    out = M.drop_near_duplicates(odd, M.Settings(shingle=2)).collect()
    assert sorted((r.doc_id or 0) for r in out) == [0, 1, 2, 3, 5, 6, 7, 8] and M.drop_near_duplicates(none).count() == 0
    df = spark.createDataFrame([(1, "b c d", 2), (1, "b c d", 1), (1, "x y z", 0), (2, "b c d", 0)], "doc_id long, text string, n int")
    assert [tuple(r) for r in M.drop_near_duplicates(df).collect()] == [(1, "b c d", 1)]


def test_repeated_ids_are_one_document(spark):
    t, u, v = "a b c d e f", "g h i j k l", "m n o p q r"
    df = spark.createDataFrame([(3, t), (5, t), (5, u), (7, u), (8, v), (9, v), (9, v)], "doc_id long, text string")
    assert as_dict(M.near_duplicates(df)) == {3: (2, 3), 5: (2, 3), 7: (2, 3), 8: (2, 8), 9: (2, 8)}
    assert [r.doc_id for r in M.drop_near_duplicates(df).orderBy("doc_id").collect()] == [3, 8]
    assert [r.doc_id for r in M.drop_near_duplicates(df, M.Settings(broadcast_ids=0)).orderBy("doc_id").collect()] == [3, 8]
    half = spark.createDataFrame([(3, t), (5, ""), (5, t), (6, ""), (6, u)], "doc_id long, text string")
    assert [tuple(r) for r in M.drop_near_duplicates(half).orderBy("doc_id").collect()] == [(3, t), (6, "")]


def test_ids_as_text(spark):
    df = spark.createDataFrame([("b", "x y z"), ("a", "X Y  z"), ("c", "p q")], "doc_id string, text string")
    assert as_dict(M.near_duplicates(df)) == {"a": (1, "a"), "b": (1, "a"), "c": (1, "c")}
