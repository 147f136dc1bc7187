"""Hand-worked cases of the boundaries."""

import re

import pytest
from pyspark.sql import functions as F

from loamline.functions import chunking as ch
from loamline.functions import cleaning as cl
from loamline.functions import language as la
from loamline.functions import quality as qu
from loamline.operators import annotate as an
from loamline.operators import guard as gu
from loamline.operators import shards as sh


def value(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("v")).first()[0]


T = None


@pytest.fixture(autouse=True)
def column(spark):
    """A column needs a session."""
    global T
    T = F.col("t")


@pytest.mark.parametrize("text,rep,alpha", [("a " * 9, 0.0, None), ("a " * 10, 0.875, None), ("ab 1", None, 0.75), ("", 0.0, 0.0), (None, 0.0, 0.0)])
def test_metrics(spark, text, rep, alpha):
    m = qu.with_metrics(spark.createDataFrame([(text,)], "text string")).first()
    assert rep is None or m["repetition_ratio"] == pytest.approx(rep)
    assert alpha is None or m["alpha_ratio"] == pytest.approx(alpha)


@pytest.mark.parametrize("n,reason", [(9, "too_few_words"), (10, None), (20, None), (21, "too_many_words")])
def test_word_bounds(spark, n, reason):
    df = spark.createDataFrame([(" ".join(f"w{i}" for i in range(n)),)], "text string")
    assert qu.with_metrics(df).select(qu.gate_reason(qu.QualityConfig(max_words=20))).first()[0] == reason


def test_cleaning(spark):
    assert value(spark, cl.remove_phones(T), "call +1 (743) 555-3824") == "call +1 (743) 555-3824"
    assert value(spark, cl.remove_phones(T, False), "call +1 (743) 555-3824") == "call "
    assert value(spark, cl.remove_phones(T), "call 743-555-3824 now") == "call  now"
    assert value(spark, cl.remove_urls(T), "see http://a.b/c?d=1, ok") == "see  ok"
    assert value(spark, cl.clean_expression(T), "“x”") == "“x”"
    assert value(spark, cl.straighten_quotes(T), "“x” ‘y’") == "\"x\" 'y'"
    assert value(spark, cl.normalise_whitespace(T), "\n\nhead  line \n\n\n\n tail \n\n") == "\n\nhead line\n\ntail\n\n"
    assert value(spark, cl.remove_short_lines(T, 10), "123456789\n1234567890\n\nx") == "1234567890\n"
    out = cl.clean(spark.createDataFrame([(None, "en"), ("  ", "en"), ("short", "en"), ("word " * 20, "fr"), ("word " * 20, None)], "text string, lang string"), cl.CleanConfig(languages=("en",)))
    assert [r.cleaning_reason for r in out.collect()] == ["empty_text", "empty_text", "too_short", "language", None]


def test_chunking(spark):
    assert value(spark, ch.sentences(T), "A b. C d! E f.") == ["A b", "C d", "E f."]
    short = ch.ChunkConfig("sentence", 100, 200)
    assert value(spark, ch.chunks_of(T, short), "w " * 49) == []
    assert value(spark, ch.chunks_of(T, short), "w " * 50) == ["w " * 50]
    assert value(spark, ch.chunks_of(T, ch.ChunkConfig("fixed", 0, 2, 0)), "a b c d e") == ["a b", "c d", "e"]
    assert value(spark, ch.chunks_of(T, ch.ChunkConfig("fixed", 0, 3, 1)), "a b c d e") == ["a b c", "c d e"]
    assert value(spark, ch.chunks_of(T, ch.ChunkConfig("fixed")), None) == []
    with pytest.raises(ValueError):
        ch.ChunkConfig("fixed", 50, 10, 10)


def pack(parts, least, most, overlap, joiner, oversize=None):
    """Plain restatement of the greedy packing."""
    done, group, n = [], [], 0
    for p in parts:
        k = len(p.split())
        if oversize and k > most:
            done += [joiner.join(group)] * bool(group) + oversize(p)
            group, n = [], 0
            continue
        if group and n + k > most:
            done.append(joiner.join(group))
            tail, size = [], 0
            for s in reversed(group):
                if size + len(s.split()) > overlap:
                    break
                tail.insert(0, s)
                size += len(s.split())
            group, n = tail, size
        group.append(p)
        n += k
    return done + ([joiner.join(group)] if group and n >= least else [])


def by_sentence(text, least, most, overlap):
    import re

    if len(text.split()) < least:
        return [text] if len(text.split()) >= 50 else []
    return pack([s.strip() for s in re.split(r"[.!?]+[\s\n]+", text) if s.strip()], least, most, overlap, " ")


def by_paragraph(text, least, most, overlap):
    if len(text.split()) < least:
        return [text] if len(text.split()) >= 50 else []
    return pack([s.strip() for s in text.split("\n\n") if s.strip()], least, most, overlap, "\n\n", lambda p: by_sentence(p, least, most, overlap))


@pytest.mark.parametrize("sizes", [(50, 100, 0), (50, 100, 20), (20, 60, 30)])
def test_chunk_folds_against_plain_python(spark, sizes):
    texts = [r.text.replace("\n", "\n\n") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(80).collect()] + ["", "one", "x. " * 300]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for method, plain in (("sentence", by_sentence), ("paragraph", by_paragraph)):
        got = {r.i: r.v for r in df.select("i", ch.chunks_of(T, ch.ChunkConfig(method, *sizes)).alias("v")).collect()}
        assert all(got[i] == plain(t, *sizes) for i, t in enumerate(texts))


def test_filter(spark):
    assert [round(value(spark, gu.confidence(F.lit(n)), ""), 3) for n in (1, 3, 5)] == [0.333, 1.0, 1.0]
    text = "Start here. " + "x" * 30 + " secret " + "y" * 30 + ". End here now."
    df = spark.createDataFrame([(text,), ("clean",), (None,), ("",)], "text string")
    cut = gu.apply_filter(df, gu.FilterConfig(("SECRET",), "remove", 10)).collect()
    assert cut[0].text == "Start here.  End here now." and cut[0].filter_sections == 1 and cut[0].removed_chars == len(text) - len(cut[0].text)
    assert [r.filter_action for r in cut] == ["removed", "none", "none", "none"] and cut[1].text == "clean"
    assert gu.apply_filter(df, gu.FilterConfig(("secret",), "reject")).first().text is None
    flag = gu.apply_filter(df, gu.FilterConfig(("secret",), "flag")).first()
    assert flag.text == text and flag.filter_action == "flagged"
    odd = gu.apply_filter(df, gu.FilterConfig(("secret",), "other")).first()
    assert odd.patterns_detected and odd.filter_action == "none"
    assert gu.apply_filter(df, gu.FilterConfig(("(",), "flag")).first().filter_matches == 0
    assert gu.sections("a" * 1000, [(100, 110), (120, 130)], 50) == [(50, 180)]
    found = spark.createDataFrame([("a1 b22 c",)], "t string").select(gu.matches(T, r"\d+").alias("m")).first().m
    assert [(m.text, m.start, m.end) for m in found] == [("1", 1, 2), ("22", 4, 6)]


def test_reapply(spark):
    df = spark.createDataFrame([("a secret b",), ("fine words",)], "text string")
    out = {r.text: r for r in gu.reapply(df, gu.FilterConfig(("secret",), "remove")).collect()}
    assert out["fine words"].outcome == "kept" and out["fine words"].word_count == 2 and out[""].outcome == "deleted"


def test_categories(spark):
    niche = an.category(T)
    assert value(spark, niche, "stock and patient") == "finance"
    assert value(spark, niche, "he said") == "technology"
    assert value(spark, niche, None) == "general" and value(spark, an.category(T, auto=False), "stock") == "general"


def test_sample(spark):
    df = spark.createDataFrame([(i, "a") for i in range(5)] + [(9, None)], "id long, g string")
    assert an.stratified_sample(df, "g", "id", 0.5).count() == 2
    assert an.stratified_sample(df, "g", "id", 1.0).count() == 6


def test_shards(spark):
    placed = sh.assign_shard(spark.range(1000), 300, "id")
    assert sorted(r["count"] for r in placed.groupBy("shard_index").count().collect()) == [100, 300, 300, 300]
    with pytest.raises(ValueError):
        sh.ShardConfig(compression="brotli")
    assert sh.select_preset(spark.range(1), "nonsense").columns == ["id"]


def test_validation(spark):
    lines = spark.createDataFrame([('{"instruction": "a", "response": ""}',), ('{"instruction": "a", "response": "b"}',), ("",), ("{",)], "value string")
    assert tuple(an.validate_records(lines).first()) == (4, 1, 3, 0.25)
    assert an.validate_records(lines.limit(0)).first().rate == 0.0


def test_language_functions():
    assert la.guess_language("the cat and the dog is in the house") == "en" and la.guess_language("") == "unknown"
    assert la.guess_language("der Hund und die Katze sind nicht in dem Haus") == "de"
    assert la.repair("cafÃ©") == "café" and la.repair("café") == "café" and la.repair(None) is None
    assert la.reading_ease("") == 50.0 and la.reading_ease("The cat sat.") > 100


@pytest.mark.parametrize("method,most", [("fixed", 2), ("sentence", 5), ("paragraph", 8)])
def test_texts_are_split_once(spark, method, most):
    """A plan that splits its text for each use grows with every chunk."""
    df = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    plan = ch.chunk(df, ch.ChunkConfig(method, 50, 100, 20))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= most


def test_long_text(spark):
    """Chunks of a text of 200,000 words: its time grows with the words, not with their square."""
    df = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some more words here. Then again it goes "), 25_000).alias("text"))
    for method in ("fixed", "sentence"):
        n = ch.chunk(df, ch.ChunkConfig(method, 50, 100, 20)).agg(F.count("*"), F.max("word_count")).first()
        assert n[0] >= 2000 and n[1] == 100


def test_patterns_of_other_dialects(spark):
    config = gu.FilterConfig(("(?P<w>foo)", "c(?#note)at", "(?P<a>x)(?P=a)", "(broken", "(?P<bad"), "remove", 0)
    assert config.invalid_patterns() == ["(broken", "(?P<bad"]
    df = spark.createDataFrame([("a FOO b",), ("the cat",), ("xx",), ("x y",)], "text string")
    assert [r.text for r in gu.apply_filter(df, config).collect()] == ["a  b", "the", "", "x y"]


def plain_sections(text, places, context):
    """The rule restated: look back and ahead for a paragraph end, then a sentence end, then stay."""
    out = []
    for a, b in places:
        lo, hi = max(0, a - context), min(len(text), b + context)
        at = [i for i in range(max(0, lo - 200), lo - 1) if text[i : i + 2] == "\n\n"] or [i for i in range(max(0, lo - 100), lo - 1) if text[i : i + 2] in (". ", ".\n")]
        after = [i for i in range(hi, min(len(text), hi + 200) - 1) if text[i : i + 2] == "\n\n"]
        dots = [i + 1 for i in range(hi, min(len(text), hi + 100) - 1) if text[i : i + 2] in (". ", ".\n")]
        out.append((at[-1] + 2 if at else lo, (after or dots or [hi])[0]))
    return {i for lo, hi in out for i in range(lo, hi)}


def test_sections_against_a_restatement():
    import random

    random.seed(4)
    for _ in range(300):
        text = "".join(random.choice(["ab", " ", ". ", ".\n", "\n", "\n\n", "wordwordword"]) for _ in range(random.randrange(1, 200)))
        places = sorted((a, min(len(text), a + random.randrange(1, 6))) for a in (random.randrange(len(text)) for _ in range(random.randrange(1, 5))))
        context = random.choice([0, 3, 40])
        got = gu.sections(text, places, context)
        assert {i for lo, hi in got for i in range(lo, hi)} == plain_sections(text, places, context)
        assert all(a[1] < b[0] for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("n", [0, 1, gu.BLOCK - 1, gu.BLOCK, gu.BLOCK + 1, 3 * gu.BLOCK, 30_000])
def test_places_of_many_matches(spark, n):
    text = " line ".join(f"é {i}.{i % 7} b" for i in range(n)) or "none"
    out = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(gu.matches(F.col("t"), r"\d+\.\d+").alias("m")).collect()
    assert [tuple(m) for m in out[0].m] == [(m.group(), m.start(), m.end()) for m in re.finditer(r"\d+\.\d+", text)]
    assert out[1].m == [] and out[2].m == []


def test_readability_is_the_plain_form(spark):
    """Over odd texts and every assigned character; without a step in Python, whose batches of whole texts grew with the table."""
    odd = ["", " \t\n", "...", "?! .", "The cat sat.", "make table ease e le agree queue  rhythm", "no stop " * 3000 + "eve" * 5000, "İstanbul Ünye naïve é ΟΔΟΣ", "a.b!c? 　. \x1f! d", "x2y ²³ ½ 12 _a_ l'e-mail Ⅷ", "aࡰb ࢈ \U0002ebf0 \U00031350 \U0001f600e"]
    odd += ["".join(map(chr, range(a, a + 64))) + "." for a in range(0, 0x32400, 64) if not 0xD800 <= a < 0xE000 and a not in (0xA7C0,)]
    odd += [f"{a}{b}{c}{d}" for a in ("", "b", "a") for b in ("l", "é", "s", "1") for c in ("e", "es", "le", "ae") for d in ("", ".", "e", "'e")]
    df = spark.createDataFrame([*enumerate(odd), (-1, None)], "doc_id long, text string").repartition(4)
    out = df.select("doc_id", la.readability(F.col("text")).alias("ease"))
    assert {r.doc_id: r.ease for r in out.collect()} == {-1: 50.0} | {i: la.reading_ease(t) for i, t in enumerate(odd)}
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
