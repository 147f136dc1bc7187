"""Mixing, sharding and rules."""

import collections
import math
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loamline.llm import mixing, queries, rules, sharding


def test_mixing_against_sql(spark, sf):
    duckdb.sql(f"create or replace view documents as select * from '{sf}/documents.parquet'")
    sql = duckdb.sql(queries.ORACLES["op5_mixing"]).fetchall()
    got = [tuple(r) for r in queries.op5_mixing(spark, sf).collect()]
    assert sorted(sql) == sorted(got)


@pytest.mark.parametrize("capped", [False, True])
def test_mixing_odd_rows_against_sql(spark, odd, capped, tmp_path):
    odd.select("doc_id", "text", "source", "lang").write.parquet(f"{tmp_path}/odd")
    form = mixing.oracle_capped if capped else mixing.oracle
    sql = duckdb.sql(form(0.5, mixing.TARGETS, docs=f"'{tmp_path}/odd/*.parquet'")).fetchall()
    out = mixing.mix(spark.read.parquet(f"{tmp_path}/odd"), 0.5, capped=capped)
    got = out.select("doc_id", "source", "lang", "topic", "tokens", F.round("probability", 6), "kept").collect()
    assert sorted(sql, key=str) == sorted(map(tuple, got), key=str)


def test_raking_meets_the_marginals(spark):
    rng = np.random.default_rng(2)
    cells = [(f"s{i}", f"l{j}", f"t{k}", int(rng.integers(1, 1000))) for i in range(5) for j in range(3) for k in range(2)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    share = {"l0": 0.5, "l1": 0.3, "l2": 0.2}
    out = mixing.rake(df, {"source": 0.5, "topic": 1.0, "lang": share}, rounds=15).collect()
    total = sum(r.tokens for r in out)
    for lang, s in share.items():
        assert sum(r.tokens * r.factor for r in out if r.lang == lang) == pytest.approx(s * total)
    tempered = {s: sum(r.tokens for r in out if r.source == s) ** 0.5 for s in {r.source for r in out}}
    for s, v in tempered.items():
        assert sum(r.tokens * r.factor for r in out if r.source == s) == pytest.approx(total * v / sum(tempered.values()), rel=1e-3)


def test_calibration(spark):
    df = spark.createDataFrame([(100, 5.0), (1000, 1.0), (3000, 0.1)], "tokens long, factor double")
    c = mixing.calibrate(df, 0.4)
    assert sum(t * min(1, c * f) for t, f in ((100, 5.0), (1000, 1.0), (3000, 0.1))) == pytest.approx(0.4 * 4100)


def filled(capacity, weight, total):
    """Aims in proportion to the weights, none above its capacity."""
    aims, open_ = {}, set(capacity)
    while True:
        c = (total - sum(aims.values())) / sum(weight[v] for v in open_)
        over = {v for v in open_ if c * weight[v] > capacity[v]}
        if not over:
            return aims | {v: c * weight[v] for v in open_}
        aims |= {v: float(capacity[v]) for v in over}
        open_ -= over


def test_kept_tokens_meet_the_marginals(spark):
    rng = np.random.default_rng(4)
    size = {"general": 60, "legal": 12, "contact": 2}
    rows = [(i, f"s{i % 3}", ("de", "en", "en", "fr")[i % 4], t, "w " * int(rng.integers(1, size[t]))) for i, t in enumerate(rng.choice(list(size), 3000))]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, text string")
    targets, share = {"source": {"s0": 0.5, "s1": 0.3, "s2": 0.2}, "lang": 0.7, "topic": 0.3}, 0.5
    out = mixing.mix(docs, share, targets, capped=True)
    rows = out.collect()
    total = sum(r.tokens for r in rows)
    assert sum(r.tokens * r.probability for r in rows) == pytest.approx(share * total, rel=1e-4)
    for name, target in targets.items():
        tokens, expected, kept = collections.Counter(), collections.Counter(), collections.Counter()
        for r in rows:
            tokens[r[name]] += r.tokens
            expected[r[name]] += r.tokens * r.probability
            kept[r[name]] += r.tokens * r.kept
        aims = filled(tokens, target if isinstance(target, dict) else {v: n**target for v, n in tokens.items()}, share * total)
        for value, aim in aims.items():
            assert expected[value] == pytest.approx(aim, rel=1e-3) and kept[value] == pytest.approx(aim, abs=0.05 * total)
    report = {(r.dimension, r.value): r for r in mixing.marginals(out, targets).collect()}
    assert not report["topic", "contact"].reachable and report["source", "s0"].reachable
    assert report["source", "s0"].expected == pytest.approx(0.5, rel=1e-3)


def test_capped_odd_rows(odd, none):
    rows = mixing.mix(odd.drop("topic"), 0.5, capped=True).collect()
    assert len(rows) == odd.count() and all(0 <= r.probability <= 1 for r in rows)
    assert sum(r.tokens * r.probability for r in rows) == pytest.approx(0.5 * sum(r.tokens for r in rows))
    assert mixing.mix(none, 0.5, capped=True).count() == 0


def test_mixing_odd_rows(odd, none):
    rows = mixing.mix(odd.drop("topic"), 0.5).collect()
    assert len(rows) == odd.count() and all(0 <= r.probability <= 1 and isinstance(r.kept, bool) for r in rows)
    assert len({r.kept for r in rows if r.doc_id == 4}) == 1
    assert mixing.mix(none, 0.5).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(odd, 0)


def test_shards(spark, sf, corpus):
    rows = queries.op6_shards(spark, sf).collect()
    text = dict(corpus)
    assert len(rows) == len(corpus) and {r.law for r in rows} == {"key"}
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        assert r.grown_shard in (r.shard, 8)
    assert set(by) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert 60 < sum(r.grown_shard == 8 for r in rows) < 170


def plain_shard(key, weights):
    """The argmin restated: two chained 64-bit hashes, -ln(u) over the weight."""
    inner = xxhash.xxh64_intdigest(str(key).encode(), 42)
    bits = [xxhash.xxh64_intdigest(f"shard {k}".encode(), inner) >> 11 for k in range(len(weights))]
    return min((-math.log((b + 0.5) / 2**53) / w, k) for k, (b, w) in enumerate(zip(bits, weights)) if w)[1]


def test_shards_against_a_plain_argmin(spark, sf):
    for r in queries.op6_shards(spark, sf).collect():
        assert r.shard == plain_shard(r.doc_id, [1.0] * 8) and r.grown_shard == plain_shard(r.doc_id, [1.0] * 9)
    w = (1.0, 2.5, 0.0, 0.3)
    for r in spark.range(2000).select("id", sharding.rendezvous_shard(F.col("id"), w).alias("s")).collect():
        assert r.s == plain_shard(r.id, w)


def test_raking_goes_on_until_the_targets_are_met(spark):
    """A cube with strong ties between its sides needs more than one block of rounds; contradicting targets end with a warning."""
    cells = [(a, b, 40 if a == b else 1) for a in "abc" for b in "abc"]
    df = spark.createDataFrame(cells, "source string, lang string, tokens long")
    targets = {"source": {"a": 0.6, "b": 0.3, "c": 0.1}, "lang": {"a": 0.2, "b": 0.2, "c": 0.6}}
    rows = mixing.rake(df, targets, rounds=2).collect()
    total = sum(r.tokens for r in rows)
    for side, shares in targets.items():
        for value, share in shares.items():
            assert abs(sum(r.tokens * r.factor for r in rows if r[side] == value) / total - share) <= mixing.GAP
    apart = spark.createDataFrame([("a", "x", 50), ("b", "y", 50)], "source string, lang string, tokens long")
    with pytest.warns(UserWarning, match="raking stops"):
        mixing.rake(apart, {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}})


def test_weights_and_growth(spark):
    keys = spark.range(20000)
    w = (1.0, 2.0, 0.0, 1.0)
    rows = keys.select(sharding.rendezvous_shard(F.col("id"), w).alias("a"), sharding.rendezvous_shard(F.col("id"), (1.0, 3.0, 0.0, 1.0)).alias("b")).collect()
    n = collections.Counter(r.a for r in rows)
    assert n[2] == 0 and abs(n[1] / 20000 - 0.5) < 0.02 and abs(n[0] / 20000 - 0.25) < 0.02
    assert all(r.a == r.b or r.b == 1 for r in rows)
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(F.col("id"), (0.0,))


def test_shards_odd_rows(odd, none):
    rows = sharding.assign_shards(odd, weights=(1.0,) * 3).collect()
    assert len(rows) == odd.count() and {r.size for r in rows if r.doc_id in (2, 3)} == {1} and all(r.grown_shard is None for r in rows)
    same = [r for r in rows if r.doc_id == 4]
    assert same[0].shard == same[1].shard and same[0].slot != same[1].slot
    assert sharding.assign_shards(none).count() == 0


def plain_measures(text):
    words = (text or "").encode().split()
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {p for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for p in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside))


def test_rules_against_plain_python(spark, sf, corpus):
    rows = {r.doc_id: r for r in queries.op7_rules(spark, sf).collect()}
    for doc_id, text in corpus:
        r, m = rows[doc_id], plain_measures(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and (not r.kept or not r.base_failed)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    fair = [rows[i].kept for i, q in labels.items() if q == 1 and not rows[i].base_failed]
    poor = [rows[i].kept for i, q in labels.items() if q == 0]
    assert sum(fair) / len(fair) > 0.99 and sum(poor) / len(poor) < 0.05


@pytest.mark.parametrize("text", ["", None, "a", "a b c", "a b c a b c", "x y z x y z x y z", "a a a a", "l\nl\n \nl\n", "a b\x1cc \x0b d", "é" * 10 + " é"])
def test_rule_measures(text):
    m = rules.measure_texts()([text])
    assert tuple(m[k][0] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == plain_measures(text)


def test_ablations_against_sql(spark, sf):
    duckdb.sql(f"create or replace view documents as select * from '{sf}/documents.parquet'")
    sql = duckdb.sql(queries.ORACLES["rule_ablations"]).fetchall()
    got = [tuple(r) for r in queries.rule_ablations(spark, sf).collect()]
    assert len(got) == len(rules.RULES) and sorted(sql) == sorted(got)


def test_policies_and_ablations(spark, odd, none):
    led = rules.ledger(odd, keep=["doc_id"])
    rows = led.collect()
    assert len(rows) == odd.count() and all(r.failed & 1 for r in rows if r.doc_id in (2, 3, 5, 8))
    out = {r.rule: r for r in rules.ablations(led, "v2").collect()}
    bits = [r.failed for r in rows]
    for rule in rules.RULES:
        assert out[rule.name].n_failed == sum(b >> rule.bit & 1 for b in bits) and out[rule.name].n_only_this == sum(b == 1 << rule.bit for b in bits)
    assert all(r.n_rows == 0 for r in rules.ablations(rules.ledger(none), "v1").collect())
    assert rules.apply_policy(led, 0).where("NOT kept").count() == 0
    assert sum(r.n for r in rules.co_failures(led).collect()) == len(rows)
    assert rules.ledger(odd).columns.count("n_words") == 1


def test_uniform_is_the_md5(spark):
    v = spark.createDataFrame([(7,)], "k long").select(mixing.uniform(F.col("k"), "s")).first()[0]
    assert v == int(hashlib.md5(b"s:7").hexdigest()[:12], 16) / 2**48
