import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.llm import queries, ranking, toxicity

SF = "/root/testdata/sf0.1"


def held_accuracy(spark, out, label, rest, mod, sf=SF):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in out.collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == rest) and 0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    return np.array(held)


def test_quality_held_out(spark):
    got = held_accuracy(spark, queries.op1_quality(spark, SF), "quality", 1, 3)
    assert (got[:, 0] == got[:, 1]).mean() > 0.97 and (got[got[:, 1] == 0][:, 0] == 0).mean() > 0.9


def test_toxicity_held_out(spark):
    got = held_accuracy(spark, queries.op3_toxicity(spark, SF), "toxic", 2, 4)
    toxic = got[got[:, 1] == 1][:, 0]
    assert toxic.mean() > 0.8 and got[got[:, 1] == 0][:, 0].mean() < 0.02


def test_ranker_orders_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, len(ranking.FEATURES)))
    w = np.zeros(x.shape[1])
    w[:3] = (2, -1, 0.5)
    y = (x @ w + rng.normal(scale=0.1, size=400) > -0.5).astype(int)
    model = ranking.fit(x, y)
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.95 and 0 < model.quantile < 1
    cos = np.dot(model.weights, w) / np.linalg.norm(model.weights) / np.linalg.norm(w)
    assert cos > 0.98


@pytest.mark.parametrize("labels,expected", [([1, 1, 1], 1), ([0, 0], 0)])
def test_one_class(labels, expected):
    x = np.ones((len(labels), len(ranking.FEATURES)))
    assert ((ranking.fit(x, labels).scores(x) >= 0.5) == expected).all()
    x = np.ones((len(labels), len(toxicity.FEATURES)))
    assert ((toxicity.fit(x, np.array(labels), np.zeros(len(labels))).scores(x) >= 0.3) == expected).all()


def test_no_rows():
    assert ranking.fit(np.zeros((0, len(ranking.FEATURES))), []).scores(np.zeros((1, len(ranking.FEATURES))))[0] == 0.5
    assert toxicity.fit(np.zeros((0, len(toxicity.FEATURES))), np.zeros(0), np.zeros(0)).scores(np.zeros((1, len(toxicity.FEATURES))))[0] == 0


def test_isotonic_is_the_pooled_mean():
    x, y = np.array([1.0, 2, 3, 4, 4]), np.array([0.0, 1, 0, 1, 0])
    at, value = toxicity.isotonic(x, y)
    assert np.allclose(np.interp([1, 2, 3, 4], at, value), [0, 0.5, 0.5, 0.5])
    assert (np.diff(value) >= 0).all()


def test_trees_against_a_plain_split():
    x = np.zeros((200, len(toxicity.FEATURES)))
    x[:, 3] = np.arange(200)
    y = (x[:, 3] >= 120).astype(float)
    forest = toxicity.fit(x, y, np.arange(200) % 4 == 0)
    assert ((forest.scores(x) >= 0.5) == y)[np.abs(np.arange(200) - 120) > 8].all()


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None), (7, 0, 0)], "doc_id long, quality int, toxic int")
    always = F.lit(True)
    for docs in (odd, none):
        model = ranking.train(docs, labels, always)
        out = ranking.score(docs, model)
        lexicon, forest = toxicity.train(docs, labels, always)
        tox = toxicity.score(docs, lexicon, forest)
        for frame in (out, tox):
            rows = frame.collect()
            assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
            assert frame.columns.count("score") == 1
    same = [r.score for r in ranking.score(odd, ranking.train(odd, labels, always)).where("doc_id in (1, 4)").collect()]
    assert len(set(same)) == 1


def test_second_person_nearness():
    flags = toxicity.BoundedCache(toxicity.Lexicon().flags)
    near = toxicity.features_of("you are an idiot", flags)
    far = toxicity.features_of("you " + "word " * 30 + "idiot", flags)
    at = toxicity.FEATURES.index("hits_near_you")
    assert near[at] == 1 and far[at] == 0
    assert toxicity.features_of("an 1d10t here", flags)[toxicity.FEATURES.index("masked_hits")] == 1


def test_distinct_hits_of_long_texts():
    word, other = sorted(toxicity.SEED_LEXICON)[:2]
    flags = toxicity.BoundedCache(toxicity.Lexicon().flags)
    at = toxicity.FEATURES.index("distinct_hits")
    for n in (1, 1000, 1001, 5000):
        assert toxicity.features_of(f"{word} " * n, flags)[at] == 1.0
    assert toxicity.features_of(f"{word} " * 2000 + other.upper() + "!", flags)[at] == 2.0
    assert toxicity.distinct_up_to((f"w{i}" for i in range(99)), 20) == 20


def test_longest_share_counts_every_word():
    words = [f"w{i}" for i in range(40)]
    for i in (3, 7, 9, 12, 22, 25, 31, 35):
        words[i] = "spam"
    share = ranking.features_of(" ".join(words), ranking.BoundedCache(ranking._marks))[ranking.FEATURES.index("longest_share")]
    assert share == 8 / 40


def test_every_pair_counts():
    """At the end the gradient over all pairs, summed one by one, vanishes; far beyond the rows of the first steps."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, len(ranking.FEATURES)))
    y = (x[:, 0] - x[:, 1] + rng.normal(size=1500) > 0.3).astype(int)
    model = ranking.fit(x, y, warm_rows=20, tolerance=1e-6)
    w, total = np.array(model.weights), 0.0
    bad = x[y == 0]
    for row in x[y == 1]:
        d = row - bad
        total = total - (1 / (1 + np.exp(np.clip(d @ w, -500, 500)))) @ d
    n = (y == 1).sum() * (y == 0).sum()
    assert np.abs(total / n + 2e-3 * w).max() < 1e-4


def test_quality_query_against_plain_scoring(spark, sf, corpus):
    import math

    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    chosen = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    marks = ranking.BoundedCache(ranking._marks)
    features = {i: ranking.features_of(t, marks) for i, t in corpus}
    usable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    model = ranking.train(docs, labels, usable)
    known = [i for i in chosen if i in features]
    again = ranking.fit(np.array([features[i] for i in known]), np.array([chosen[i] for i in known]))
    assert np.allclose(model.weights, again.weights, atol=1e-2) and len(known) > 100
    for r in queries.op1_quality(spark, sf).collect():
        z = sum(w * f for w, f in zip(model.weights, features[r.doc_id])) - model.threshold
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-500, min(500, z)))), abs=1e-9) and r.predicted == (r.score >= 0.5)


def test_toxicity_query_against_plain_trees(spark, sf, corpus):
    """Trees walked node by node, the isotonic steps by a search in plain Python."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    lexicon, forest = toxicity.train(docs, labels, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    flags = toxicity.BoundedCache(lexicon.flags)
    text = dict(corpus)

    def plain(x):
        total = forest.base
        for feature, cut, leaf in forest.trees:
            node, depth = 0, 0
            while 2**depth < len(leaf):
                node = 2 * node + (2 if x[feature[node]] > cut[node] else 1)
                depth += 1
            total += leaf[node - (len(leaf) - 1)]
        return total

    out = queries.op3_toxicity(spark, sf).collect()
    got = {r.doc_id: r.score for r in out}
    margins = {i: plain(toxicity.features_of(t, flags)) for i, t in text.items()}
    steps = [(float(a), float(b)) for a, b in zip(forest.steps_at, forest.steps_value)]
    for i, m in margins.items():
        assert got[i] == pytest.approx(float(np.interp(m, [a for a, _ in steps], [b for _, b in steps])), abs=1e-9)
    assert all(r.predicted == (r.score >= 0.3) for r in out)


def test_equal_texts_have_equal_scores(spark):
    model = ranking.Ranker(tuple(0.1 for _ in ranking.FEATURES), 0.2, 0.5)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["same words", "same words", None, ""])], "doc_id long, text string")
    s = [r.score for r in ranking.score(df, model).orderBy("doc_id").collect()]
    assert s[0] == s[1] and s[2] == s[3]
