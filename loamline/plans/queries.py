"""The registered queries of the text-preparation operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions import chunking as ch
from loamline.functions import cleaning as cl
from loamline.functions import language as la
from loamline.functions import quality as qu
from loamline.functions import text as tx
from loamline.operators import annotate as an
from loamline.operators import dedup as de
from loamline.operators import guard as gu
from loamline.operators import profile as pr
from loamline.operators import shards as sh
from loamline.plans import pipeline as pl
from loamline.session import materialise, small_batches, spread
from loamline.sources import extract as ex

W = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table; batches of its texts that go to Python are bounded."""
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def s_words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{W}+'), lambda x: x <> '')"


def s_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{W}+|{W}+$', '', 'g')"


S_METRICS = f"""m0 AS (SELECT doc_id, text, {s_words('text')} AS w, {s_words('lower(text)')} AS l FROM documents),
m AS (SELECT doc_id, text, len(w) AS word_count, len(list_distinct(l)) AS unique_words,
  CASE WHEN len(w) = 0 THEN 0.0 ELSE len(list_distinct(l)) / len(w) END AS unique_ratio,
  CASE WHEN len(l) < 10 THEN 0.0 ELSE 1 - len(list_distinct(list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2]))) / (len(l) - 2) END AS repetition_ratio,
  CASE WHEN length(text) = 0 THEN 0.0 ELSE length(regexp_replace(text, '[^\\pL{W[1:-1]}]', '', 'g')) / length(text) END AS alpha_ratio FROM m0)"""
S_REASON = """CASE WHEN word_count < 50 THEN 'too_few_words' WHEN word_count > 100000 THEN 'too_many_words' WHEN unique_ratio < 0.3 THEN 'low_unique_ratio'
  WHEN repetition_ratio > 0.5 THEN 'high_repetition' WHEN alpha_ratio < 0.7 THEN 'low_alpha_ratio' END"""


@query(f"SELECT doc_id, len({s_words('text')}) AS word_count, length(text) AS char_count FROM documents")
def word_metrics(spark, d):
    return docs(spark, d).select("doc_id", tx.word_count(F.col("text")).alias("word_count"), tx.char_count(F.col("text")).alias("char_count"))


@query(f"WITH {S_METRICS} SELECT doc_id, word_count, unique_words, round(unique_ratio, 9) AS unique_ratio, round(repetition_ratio, 9) AS repetition_ratio, round(alpha_ratio, 9) AS alpha_ratio FROM m")
def quality_metrics(spark, d):
    m = qu.with_metrics(docs(spark, d))
    return m.select("doc_id", "word_count", "unique_words", *[F.round(c, 9).alias(c) for c in ("unique_ratio", "repetition_ratio", "alpha_ratio")])


@query(f"WITH {S_METRICS} SELECT doc_id, {S_REASON} AS reason FROM m")
def quality_gate(spark, d):
    return qu.with_metrics(docs(spark, d)).select("doc_id", qu.gate_reason(qu.QualityConfig.strict()).alias("reason"))


@query(f"WITH {S_METRICS}, r AS (SELECT coalesce({S_REASON}, 'kept') AS reason FROM m) SELECT reason, count(*) AS n FROM r GROUP BY reason")
def removal_reasons(spark, d):
    return quality_gate(spark, d).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def _stimulus(spark, d, *parts):
    return docs(spark, d).select("doc_id", F.concat(*parts).alias("text"))


S_URL = "text || ' see https://site' || doc_id || '.example.org/a?b=' || doc_id || ' and http://x.y/Z_1-2 end'"
S_MAIL = "'mail user.' || doc_id || '@mail' || (doc_id % 7) || '.example.org now ' || text"
S_PHONE = "'call ' || lpad((doc_id % 1000)::VARCHAR, 3, '2') || '-555-' || lpad((doc_id % 10000)::VARCHAR, 4, '0') || ' or (743) 555-3824 or 7435553824. ' || text"
PHONE_SQL = r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"


@query(f"SELECT doc_id, regexp_replace({S_URL}, 'https?://[!$-_a-z]+', '', 'g') AS cleaned FROM documents")
def remove_urls(spark, d):
    s = _stimulus(spark, d, "text", F.lit(" see https://site"), "doc_id", F.lit(".example.org/a?b="), "doc_id", F.lit(" and http://x.y/Z_1-2 end"))
    return s.select("doc_id", cl.remove_urls(F.col("text")).alias("cleaned"))


@query(rf"SELECT doc_id, regexp_replace({S_MAIL}, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}\b', '', 'g') AS cleaned FROM documents")
def remove_emails(spark, d):
    s = _stimulus(spark, d, F.lit("mail user."), "doc_id", F.lit("@mail"), F.col("doc_id") % 7, F.lit(".example.org now "), "text")
    return s.select("doc_id", cl.remove_emails(F.col("text")).alias("cleaned"))


@query(f"SELECT doc_id, regexp_replace({S_PHONE}, '{PHONE_SQL}', '', 'g') AS cleaned FROM documents")
def remove_phones(spark, d):
    s = _stimulus(spark, d, F.lit("call "), F.lpad((F.col("doc_id") % 1000).cast("string"), 3, "2"), F.lit("-555-"), F.lpad((F.col("doc_id") % 10000).cast("string"), 4, "0"), F.lit(" or (743) 555-3824 or 7435553824. "), "text")
    return s.select("doc_id", cl.remove_phones(F.col("text")).alias("cleaned"))


S_SPACED = "chr(10) || chr(10) || replace(text, '. ', '.  ' || chr(10) || chr(10) || ' ' || chr(10)) || ' ' || chr(10)"
S_NORMAL = lambda c: f"array_to_string(list_transform(string_split(regexp_replace(regexp_replace({c}, ' +', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), chr(10)), lambda x: {s_strip('x')}), chr(10))"


@query(f"SELECT doc_id, {S_NORMAL(S_SPACED)} AS cleaned FROM documents")
def normalise_whitespace(spark, d):
    c = F.concat(F.lit("\n\n"), F.replace(F.col("text"), F.lit(". "), F.lit(".  \n\n \n")), F.lit(" \n"))
    return docs(spark, d).select("doc_id", cl.normalise_whitespace(c).alias("cleaned"))


@query(f"SELECT doc_id, array_to_string(list_filter(string_split(replace(text, '. ', '.' || chr(10)), chr(10)), lambda x: length({s_strip('x')}) >= 40 OR {s_strip('x')} = ''), chr(10)) AS cleaned FROM documents")
def drop_short_lines(spark, d):
    return docs(spark, d).select("doc_id", cl.remove_short_lines(F.replace(F.col("text"), F.lit(". "), F.lit(".\n")), 40).alias("cleaned"))


S_CLEAN = S_NORMAL(rf"regexp_replace(regexp_replace(regexp_replace({S_URL}, 'https?://[!$-_a-z]+', '', 'g'), '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}\b', '', 'g'), '{PHONE_SQL}', '', 'g')")


@query(f"""WITH c AS (SELECT doc_id, lang, length({S_URL}) AS o, {S_CLEAN} AS cleaned FROM documents)
SELECT doc_id, cleaned, o AS original_length, length(cleaned) AS cleaned_length, round((o - length(cleaned)) / o, 9) AS reduction_ratio,
  CASE WHEN lang NOT IN ('en', 'de') THEN 'language' WHEN length(cleaned) < 50 THEN 'too_short' END AS cleaning_reason FROM c""")
def clean_chain(spark, d):
    s = docs(spark, d).select("doc_id", "lang", F.concat("text", F.lit(" see https://site"), "doc_id", F.lit(".example.org/a?b="), "doc_id", F.lit(" and http://x.y/Z_1-2 end")).alias("text"))
    out = cl.clean(s, cl.CleanConfig(languages=("en", "de")))
    return out.select("doc_id", "cleaned", "original_length", "cleaned_length", F.round("reduction_ratio", 9).alias("reduction_ratio"), "cleaning_reason")


S_SENTENCES = f"list_filter(list_transform(regexp_split_to_array(text, '[.!?]+[\\s]+'), lambda x: {s_strip('x')}), lambda x: x <> '')"


@query(f"WITH s AS (SELECT doc_id, {S_SENTENCES} AS p FROM documents) SELECT doc_id, len(p) AS n, md5(array_to_string(p, '|')) AS digest FROM s")
def split_sentences(spark, d):
    p = ch.sentences(F.col("text"))
    return docs(spark, d).select("doc_id", p.alias("p")).select("doc_id", F.size("p").cast("long").alias("n"), F.md5(F.array_join("p", "|")).alias("digest"))


S_PARAGRAPHS = f"list_filter(list_transform(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda x: {s_strip('x')}), lambda x: x <> '')"


def _doubled(spark, d):
    return docs(spark, d).select("doc_id", F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")).alias("text"))


@query(f"WITH s AS (SELECT doc_id, {S_PARAGRAPHS} AS p FROM documents) SELECT doc_id, len(p) AS n, md5(array_to_string(p, '|')) AS digest FROM s")
def split_paragraphs(spark, d):
    return _doubled(spark, d).select("doc_id", ch.paragraphs(F.col("text")).alias("p")).select("doc_id", F.size("p").cast("long").alias("n"), F.md5(F.array_join("p", "|")).alias("digest"))


def s_fixed(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""WITH w AS (SELECT doc_id, {s_words('text')} AS w FROM documents),
c AS (SELECT doc_id, w, unnest(range(0, greatest(1, ceil((len(w) - {overlap}) / {step})::BIGINT))) AS i FROM w WHERE len(w) > 0)
SELECT doc_id, i AS chunk_index, md5(array_to_string(w[i * {step} + 1 : i * {step} + {size}], ' ')) AS digest, len(w[i * {step} + 1 : i * {step} + {size}]) AS word_count FROM c"""


def _chunks(frame, config):
    out = ch.chunk(frame.select("doc_id", "text"), config)
    return out.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.md5("text").alias("digest"), "word_count")


@query(s_fixed(100, 0))
def chunk_fixed(spark, d):
    return _chunks(docs(spark, d), ch.ChunkConfig("fixed", 50, 100, 0))


@query(s_fixed(100, 20))
def chunk_fixed_overlap(spark, d):
    return _chunks(docs(spark, d), ch.ChunkConfig("fixed", 50, 100, 20))


def s_packed(parts: str, least: int, most: int, overlap: int) -> str:
    """Greedy packing by a recursive walk over the parts: lo is where the group starts, done the group that a part closes."""
    full = f"w.i > w.lo AND w.held + p.k[w.i] > {most}"
    tail = f"list_min(list_filter(range(w.lo, w.i + 1), lambda j: list_sum(p.k[j : w.i - 1]) <= {overlap} OR j = w.i))"
    return f"""WITH RECURSIVE p0 AS (SELECT doc_id, text, len({s_words('text')}) AS n, {parts} AS p FROM documents),
p AS (SELECT doc_id, text, n, p, list_transform(p, lambda x: len({s_words('x')})) AS k FROM p0),
walk AS (SELECT doc_id, 1::BIGINT AS i, 1::BIGINT AS lo, 0::HUGEINT AS held, NULL::BIGINT AS done, 0::BIGINT AS g FROM p WHERE n >= {least} AND len(p) > 0
  UNION ALL SELECT doc_id, i + 1, start, coalesce(list_sum(k[start : i]), 0)::HUGEINT, done, g + (done IS NOT NULL)::BIGINT
  FROM (SELECT w.doc_id, w.i, w.g, p.k, CASE WHEN {full} THEN {tail} ELSE w.lo END AS start, CASE WHEN {full} THEN w.lo END AS done FROM walk w JOIN p ON w.doc_id = p.doc_id WHERE w.i <= len(p.k))),
groups AS (SELECT doc_id, g - 1 AS g, done AS lo, i - 2 AS hi, false AS last FROM walk WHERE done IS NOT NULL
  UNION ALL SELECT w.doc_id, w.g, w.lo, len(p.p), true FROM walk w JOIN p ON w.doc_id = p.doc_id WHERE w.i = len(p.p) + 1 AND w.held >= {least}),
made AS (SELECT p.doc_id, g.g AS chunk_index, array_to_string(p.p[g.lo : g.hi], ' ') AS text FROM groups g JOIN p ON g.doc_id = p.doc_id
  UNION ALL SELECT doc_id, 0, text FROM p WHERE n < {least} AND n >= 50)
SELECT doc_id, chunk_index::BIGINT AS chunk_index, md5(text) AS digest, len({s_words('text')}) AS word_count FROM made"""


@query(s_packed(S_SENTENCES, 50, 100, 0))
def chunk_sentence(spark, d):
    return _chunks(docs(spark, d), ch.ChunkConfig("sentence", 50, 100, 0))


@query(s_packed(S_SENTENCES, 50, 100, 20))
def chunk_sentence_overlap(spark, d):
    return _chunks(docs(spark, d), ch.ChunkConfig("sentence", 50, 100, 20))


@query()
def chunk_paragraph(spark, d):
    return _chunks(_doubled(spark, d), ch.ChunkConfig("paragraph", 50, 100, 20))


@query("SELECT doc_id, sha256(text) AS text_sha256, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS is_duplicate FROM documents")
def exact_dedup(spark, d):
    return de.exact_dedup(docs(spark, d).select("doc_id", "text")).select("doc_id", "text_sha256", "is_duplicate")


@query("SELECT sha256(text) AS text_sha256, count(*) AS group_size, min(doc_id) AS first_id FROM documents GROUP BY text HAVING count(*) > 1")
def exact_dup_groups(spark, d):
    return de.duplicate_groups(docs(spark, d))


S_NUMBER = lambda s: f"(('0x' || substr(md5({s}), 1, 8))::BIGINT & 2147483647)"
S_MINIMA = f"""h AS (SELECT doc_id, {S_NUMBER('word')} AS h FROM (SELECT doc_id, unnest(list_distinct({s_words('lower(text)')})) AS word FROM documents)),
c AS (SELECT i, 1 + {S_NUMBER("'a:' || i")} % 2147483646 AS a, {S_NUMBER("'b:' || i")} % 2147483647 AS b FROM range(128) t(i)),
v AS (SELECT doc_id, i, min((a * h + b) % 2147483647) AS v FROM h, c GROUP BY doc_id, i)"""
S_LINKS = f"""{S_MINIMA},
k AS (SELECT doc_id, i // 13 AS band, md5(string_agg(v::VARCHAR, ',' ORDER BY i)) AS bucket FROM v WHERE i < 117 GROUP BY doc_id, i // 13),
f AS (SELECT band, bucket, min(doc_id) AS first FROM k GROUP BY band, bucket),
links AS (SELECT DISTINCT f.first, k.doc_id FROM k JOIN f ON k.band = f.band AND k.bucket = f.bucket WHERE k.doc_id <> f.first)"""


@query(f"WITH {S_MINIMA} SELECT doc_id, string_agg(v::VARCHAR, ',' ORDER BY i) AS signature FROM v GROUP BY doc_id")
def minhash_signature(spark, d):
    out = de.minhash(docs(spark, d)).where(F.size("signature") > 0)
    return out.select("doc_id", F.array_join(F.transform("signature", lambda x: x.cast("string")), ",").alias("signature"))


def _lsh(spark, d):
    return materialise(de.lsh_members(de.minhash(docs(spark, d)), *de.LshConfig().split()), "members")


@query(f"WITH {S_LINKS} SELECT first, doc_id FROM links")
def lsh_links(spark, d):
    return de.lsh_first_links(_lsh(spark, d))


@query(f"""WITH {S_LINKS}, s AS (SELECT doc_id, list_distinct({s_words('lower(text)')}) AS w FROM documents),
j AS (SELECT l.first, l.doc_id, len(list_intersect(a.w, b.w)) AS i, len(a.w) + len(b.w) AS n FROM links l JOIN s a ON a.doc_id = l.first JOIN s b ON b.doc_id = l.doc_id)
SELECT first, doc_id, round(i / (n - i), 9) AS jaccard FROM j WHERE i / (n - i) >= 0.8""")
def jaccard_links(spark, d):
    return de.verified_links(docs(spark, d), de.lsh_first_links(_lsh(spark, d)), 0.8).withColumn("jaccard", F.round("jaccard", 9))


@query(f"""WITH RECURSIVE {S_LINKS}, shared AS (SELECT band, bucket FROM k GROUP BY band, bucket HAVING count(*) > 1),
d AS (SELECT doc_id, list(k.band || ':' || k.bucket) AS b, row_number() OVER (ORDER BY doc_id) AS i FROM k JOIN shared USING (band, bucket) GROUP BY doc_id),
walk AS (SELECT 0::BIGINT AS i, []::VARCHAR[] AS kept, NULL::BIGINT AS fallen
  UNION ALL SELECT w.i + 1, CASE WHEN list_has_any(w.kept, d.b) THEN w.kept ELSE list_concat(w.kept, d.b) END, CASE WHEN list_has_any(w.kept, d.b) THEN d.doc_id END FROM walk w JOIN d ON d.i = w.i + 1)
SELECT doc_id, doc_id IN (SELECT fallen FROM walk WHERE fallen IS NOT NULL) AS is_near_duplicate FROM documents""")
def near_dedup(spark, d):
    return de.near_dedup(docs(spark, d))


PATTERNS = (r"[a-z0-9._]+@[a-z0-9.]+", r"\d+\.\d+\.\d+\.\d+", r"token\s*=", "mit license")
S_MATCHES = " + ".join(f"len(regexp_extract_all(text, '(?im){p}'))" for p in PATTERNS)


def _filter(action: str) -> gu.FilterConfig:
    return gu.FilterConfig((*PATTERNS, "(broken"), action, 200)


@query(f"SELECT doc_id, {S_MATCHES} AS filter_matches, ({S_MATCHES}) > 0 AS patterns_detected, round(least(({S_MATCHES}) / 3.0, 1.0), 9) AS filter_confidence FROM documents")
def filter_detect(spark, d):
    return gu.apply_filter(docs(spark, d), _filter("flag")).select("doc_id", F.col("filter_matches").cast("long").alias("filter_matches"), "patterns_detected", F.round("filter_confidence", 9).alias("filter_confidence"))


@query(f"SELECT doc_id, CASE WHEN ({S_MATCHES}) > 0 THEN 'flagged' ELSE 'none' END AS filter_action, md5(text) AS digest FROM documents")
def filter_flag(spark, d):
    return gu.apply_filter(docs(spark, d), _filter("flag")).select("doc_id", "filter_action", F.md5("text").alias("digest"))


@query(f"SELECT doc_id, CASE WHEN ({S_MATCHES}) > 0 THEN 'rejected' ELSE 'none' END AS filter_action, CASE WHEN ({S_MATCHES}) = 0 THEN md5(text) END AS digest FROM documents")
def filter_reject(spark, d):
    return gu.apply_filter(docs(spark, d), _filter("reject")).select("doc_id", "filter_action", F.md5("text").alias("digest"))


@query()
def filter_remove(spark, d):
    return gu.apply_filter(docs(spark, d), _filter("remove")).select("doc_id", "filter_action", "text", "filter_sections", "removed_chars")


@query(f"SELECT count(*) AS total, count(*) FILTER (({S_MATCHES}) > 0) AS detected, 0::BIGINT AS removed, count(*) FILTER (({S_MATCHES}) > 0) AS flagged, 0::BIGINT AS rejected, 0::BIGINT AS emptied, 0::BIGINT AS removed_chars FROM documents")
def filter_summary(spark, d):
    return gu.filter_summary(gu.apply_filter(docs(spark, d), _filter("flag")))


@query(rf"""WITH m AS (SELECT doc_id, text, regexp_extract_all(text, '(?i)[a-z0-9._]+@[a-z0-9.]+') AS found FROM documents)
SELECT doc_id, len(found) AS n, CASE WHEN len(found) > 0 THEN instr(text, found[1]) - 1 END AS first_start, array_to_string(found, ' ') AS found FROM m""")
def filter_positions(spark, d):
    m = docs(spark, d).select("doc_id", gu.matches(F.col("text"), PATTERNS[0]).alias("m"))
    return m.select("doc_id", F.size("m").cast("long").alias("n"), F.get("m", F.lit(0))["start"].cast("long").alias("first_start"), F.array_join(F.transform("m", lambda x: x["text"]), " ").alias("found"))


@query(rf"""WITH m AS (SELECT doc_id, {' , '.join(f"regexp_extract_all(text, '(?im){p}') AS m{i}" for i, p in enumerate(PATTERNS))} FROM documents)
SELECT doc_id, len(m0) + len(m1) + len(m2) + len(m3) AS n, array_to_string(list_transform(list_concat(list_concat(m0, m1), list_concat(m2, m3)), lambda x: left(x, 100)), '|') AS found FROM m""")
def filter_match_list(spark, d):
    m = docs(spark, d).select("doc_id", gu.detections(F.col("text"), _filter("flag")).alias("m"))
    return m.select("doc_id", F.size("m").cast("long").alias("n"), F.array_join(F.transform("m", lambda x: x["text"]), "|").alias("found"))


@query()
def filter_retroactive(spark, d):
    chunks = ch.chunk(docs(spark, d).select("doc_id", "text"), ch.ChunkConfig("fixed", 50, 200, 0))
    out = gu.reapply(chunks, _filter("remove"))
    return out.groupBy("outcome").agg(F.count("*").alias("n"), F.sum("removed_chars").cast("long").alias("removed_chars"))


TOPICS = {"general": (), "finance": ("thre", "onto"), "health": ("tion", "ción"), "technology": ("lich", "AI"), "science": ("ment", "ing")}
S_SCORE = lambda ks: " + ".join(f"contains(lower(text), '{k.lower()}')::INT" for k in ks)
S_SCORES = ", ".join(f"{S_SCORE(ks)} AS {n}" for n, ks in TOPICS.items() if ks)
S_NICHE = f"""n0 AS (SELECT *, {S_SCORES} FROM documents),
n AS (SELECT *, CASE WHEN greatest(finance, health, technology, science) = 0 THEN 'general' {' '.join(f"WHEN {k} = greatest(finance, health, technology, science) THEN '{k}'" for k, v in TOPICS.items() if v)} END AS niche FROM n0)"""


@query(f"WITH {S_NICHE} SELECT doc_id, niche FROM n")
def categories(spark, d):
    return an.categorise(docs(spark, d), TOPICS).select("doc_id", "niche")


@query(f"WITH {S_NICHE} SELECT niche, count(*) AS n FROM n GROUP BY niche")
def category_counts(spark, d):
    return an.count_by(an.categorise(docs(spark, d), TOPICS))


@query(f"WITH {S_NICHE} SELECT doc_id::VARCHAR AS id, niche, lang AS language, len({s_words('text')}) AS word_count, source AS source_file FROM n")
def annotations(spark, d):
    rows = an.categorise(docs(spark, d), TOPICS).withColumn("word_count", tx.word_count(F.col("text"))).withColumn("language", F.col("lang")).withColumn("source_file", F.col("source")).withColumn("chunk_id", F.col("doc_id").cast("string"))
    return an.annotation_records(rows).select("id", "niche", "metadata.language", "metadata.word_count", "metadata.source_file")


@query("WITH g AS (SELECT lang, floor(count(*) * 0.3)::BIGINT AS n FROM documents GROUP BY lang) SELECT lang, n FROM g WHERE n > 0")
def sample_sizes(spark, d):
    return an.stratified_sample(docs(spark, d), "lang", "doc_id", 0.3).groupBy("lang").agg(F.count("*").alias("n"))


@query()
def stratified_sample(spark, d):
    return an.stratified_sample(docs(spark, d).select("doc_id", "lang"), "lang", "doc_id", 0.3)


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index, (row_number() OVER (ORDER BY doc_id) - 1) // 300 AS shard_index FROM documents")
def shard_assignment(spark, d):
    return sh.assign_shard(docs(spark, d).select("doc_id"), 300, "doc_id")


@query("WITH s AS (SELECT greatest(100, floor(1048576 / avg(strlen(text)))::BIGINT) AS r FROM (SELECT text FROM documents ORDER BY doc_id LIMIT 100)) SELECT count(*) AS total_chunks, ceil(count(*) / any_value(r))::BIGINT AS total_shards, 'snappy' AS compression FROM documents, s")
def shard_metadata(spark, d):
    rows = docs(spark, d)
    config = sh.ShardConfig(max_mb=1.0)
    return sh.shard_metadata(sh.assign_shard(rows.select("doc_id"), sh.rows_per_shard(rows, config, "doc_id"), "doc_id")).select("total_chunks", "total_shards", "compression")


@query(f"SELECT doc_id::VARCHAR AS id, text, lang AS language, len({s_words('text')}) AS word_count FROM documents")
def schema_presets(spark, d):
    rows = docs(spark, d).select(F.col("doc_id").cast("string").alias("id"), "text", F.col("lang").alias("language"), tx.word_count(F.col("text")).alias("word_count"), "n_chars")
    return sh.select_preset(rows, "standard")


@query(f"""WITH x AS (SELECT len({s_words('text')}) AS w, length(text) AS c FROM documents) SELECT count(*) AS n, min(w) AS min_words, max(w) AS max_words, round(avg(w), 6) AS mean_words,
quantile_cont(w, 0.5) AS median_words, round(stddev_samp(w), 6) AS std_words, min(c) AS min_chars, max(c) AS max_chars, round(avg(c), 6) AS mean_chars FROM x""")
def length_profile(spark, d):
    out = pr.length_profile(docs(spark, d), tx.word_count(F.col("text")), F.length("text"))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_words", "std_words", "mean_chars")})


@query(f"""WITH x AS (SELECT len({s_words('text')}) AS w FROM documents), b AS (SELECT CASE WHEN w <= 256 THEN '<=256' WHEN w <= 512 THEN '257-512' WHEN w <= 1024 THEN '513-1024' ELSE '>=1025' END AS bucket FROM x)
SELECT bucket, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM b), 6) AS percent FROM b GROUP BY bucket""")
def length_histogram(spark, d):
    return pr.length_histogram(docs(spark, d), tx.word_count(F.col("text"))).withColumn("percent", F.round("percent", 6))


@query('SELECT "column", non_null, round(100.0 * ((SELECT count(*) FROM events) - non_null) / (SELECT count(*) FROM events), 6) AS null_percent FROM (' + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS non_null FROM events" for c in ("event_id", "ts", "user_id", "event_type", "value", "props")) + ")")
def null_profile(spark, d):
    return pr.null_profile(table(spark, d, "events")).withColumn("null_percent", F.round("null_percent", 6))


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM events" for c in ("user_id", "event_type", "value")))
def distinct_profile(spark, d):
    return pr.distinct_profile(table(spark, d, "events"), ["user_id", "event_type", "value"])


@query("SELECT event_type AS value, count(*) AS n, round(100.0 * count(*) / (SELECT count(event_type) FROM events), 6) AS percent FROM events WHERE event_type IS NOT NULL AND (SELECT count(DISTINCT event_type) FROM events) <= 20 GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def value_counts_topk(spark, d):
    return pr.value_counts(table(spark, d, "events"), "event_type").withColumn("percent", F.round("percent", 6))


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", min({c})::DOUBLE AS \"min\", max({c})::DOUBLE AS \"max\", round(avg({c}), 6) AS mean FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_linenumber")))
def numeric_profile(spark, d):
    return pr.numeric_profile(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"]).withColumn("mean", F.round("mean", 6))


@query(f"WITH x AS (SELECT source, len({s_words('text')}) AS w FROM documents) SELECT source, count(*) AS n, min(w) AS min_words, max(w) AS max_words, round(avg(w), 6) AS mean_words FROM x GROUP BY source")
def chunk_stats(spark, d):
    return pr.chunk_stats(docs(spark, d), "source", tx.word_count(F.col("text"))).withColumn("mean_words", F.round("mean_words", 6))


@query(f"WITH x AS (SELECT len({s_words('text')}) * 1.33::DOUBLE AS t FROM documents) SELECT CASE WHEN t < 256 THEN 'small' WHEN t <= 768 THEN 'medium' ELSE 'large' END AS size_class, count(*) AS n FROM x GROUP BY 1")
def size_classes(spark, d):
    c = pr.size_class(pr.token_estimate(tx.word_count(F.col("text"))))
    return docs(spark, d).groupBy(c.alias("size_class")).agg(F.count("*").alias("n"))


@query(f"""WITH w AS (SELECT doc_id, i, array_to_string({s_words('text')}[i * 80 + 1 : i * 80 + 100], ' ') AS text FROM (SELECT doc_id, text, unnest(range(0, greatest(1, ceil((len({s_words('text')}) - 20) / 80)::BIGINT))) AS i FROM documents) WHERE len({s_words('text')}) > 0),
p AS (SELECT doc_id, i, text, lead(text) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM w),
o AS (SELECT doc_id, i, text, coalesce(list_max(list_filter(range(20, 201), lambda n: n <= least(length(text), length(after)) AND right(text, n) = left(after, n))), 0) AS k FROM p WHERE after IS NOT NULL)
SELECT doc_id, i AS chunk_index, k AS overlap_chars FROM o""")
def chunk_overlap(spark, d):
    chunks = ch.chunk(docs(spark, d).select("doc_id", "text"), ch.ChunkConfig("fixed", 50, 100, 20))
    out = pr.consecutive_overlap(chunks, ["chunk_index"], ["doc_id"])
    return out.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("overlap_chars").cast("long").alias("overlap_chars"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def group_counts(spark, d):
    return pr.group_counts(docs(spark, d), "source")


@query("SELECT lang, round(count(*) FILTER (n_chars > 500) / count(*), 9) AS completion FROM documents GROUP BY lang")
def completion(spark, d):
    done = docs(spark, d).groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") > 500).alias("done"))
    return done.select("lang", F.round(an.completion(F.col("n"), F.col("done")), 9).alias("completion"))


@query("SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 3")
def head(spark, d):
    return pr.head(docs(spark, d).select("doc_id", "n_chars"), "doc_id")


@query("SELECT doc_id, n_chars FROM documents ORDER BY doc_id DESC LIMIT 3")
def tail(spark, d):
    return pr.tail(docs(spark, d).select("doc_id", "n_chars"), "doc_id")


def _tasks(spark, d) -> DataFrame:
    """Annotated tasks built from conversations: an older annotation, then one with the first user and assistant turns."""
    part = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn")))
    c = table(spark, d, "conversations").groupBy("conv_id").agg(part("user").alias("u"), part("assistant").alias("a"))
    kind = "struct<from_name:string,value:struct<text:array<string>,choices:array<string>,rating:bigint>>"
    item = lambda name, t, choice, rating: F.struct(F.lit(name).alias("from_name"), F.struct(t.alias("text"), choice.alias("choices"), rating.alias("rating")).alias("value")).cast(kind)
    none, no = F.lit(None).cast("array<string>"), F.lit(None).cast("bigint")
    newest = F.array(
        item("instruction", F.array(F.lit("older")), none, no), item("instruction", F.array("u"), none, no), item("response", F.array("a"), none, no),
        item("input_context", F.when(F.col("conv_id") % 2 == 0, F.array(F.concat(F.lit("context "), F.col("conv_id").cast("string")))).otherwise(none), none, no),
        item("niche", none, F.array(F.when(F.col("conv_id") % 3 == 0, "science").otherwise("")), no), item("quality", none, none, F.col("conv_id") % 5),
    )
    old = F.struct(F.lit("2020").alias("created_at"), F.array(item("response", F.array(F.lit("old")), none, no)).alias("result"))
    new = F.struct(F.lit("2021").alias("created_at"), newest.alias("result"))
    notes = F.when(F.col("conv_id") % 7 == 0, F.filter(F.array(old), lambda x: F.lit(False))).otherwise(F.array(old, new))
    return c.select(F.struct(F.col("conv_id").cast("string").alias("id"), F.col("u").alias("text"), F.lit("general").alias("niche")).alias("data"), notes.alias("annotations"))


S_SFT = """c AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS u, arg_min(text, turn) FILTER (role = 'assistant') AS a FROM conversations GROUP BY conv_id),
s AS (SELECT conv_id::VARCHAR AS id, coalesce(u, '') AS instruction, CASE WHEN conv_id % 2 = 0 THEN 'context ' || conv_id ELSE '' END AS input, coalesce(a, '') AS response, CASE WHEN conv_id % 3 = 0 THEN 'science' ELSE 'general' END AS niche, conv_id % 5 AS quality_rating, coalesce(u, '') AS original_text, '2021' AS annotation_timestamp FROM c WHERE conv_id % 7 <> 0)"""


@query(f"WITH {S_SFT} SELECT * FROM s")
def sft_records(spark, d):
    return an.sft_records(_tasks(spark, d))


@query(f"WITH {S_SFT} SELECT count(*) AS total, count(*) FILTER (instruction <> '' AND response <> '') AS valid, count(*) FILTER (NOT (instruction <> '' AND response <> '')) AS invalid, round(count(*) FILTER (instruction <> '' AND response <> '') / count(*), 9) AS rate FROM (SELECT instruction, response FROM s UNION ALL SELECT '', '' UNION ALL SELECT '', '')")
def sft_validation(spark, d):
    lines = sft_records(spark, d).select(F.to_json(F.struct("instruction", "response")).alias("value"))
    broken = spark.createDataFrame([("",), ("{not json",)], "value string")
    return an.validate_records(lines.unionByName(broken)).withColumn("rate", F.round("rate", 9))


@query(f"WITH {S_SFT} SELECT niche, count(*) AS n FROM s GROUP BY niche")
def sft_by_category(spark, d):
    return an.count_by(sft_records(spark, d))


@query("SELECT '' || conv_id AS id, text, 'general' AS niche FROM conversations")
def annotation_tasks(spark, d):
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("id"), "text", F.lit(None).cast("string").alias("niche"))
    return an.task_records(rows).select("data.id", "data.text", "data.niche")


@query("SELECT doc_id, lang AS language, n_chars AS char_count, CASE WHEN n_chars > 500 THEN n_chars / 10.0::DOUBLE END AS readability_score FROM documents")
def flat_records(spark, d):
    metrics = F.struct(F.when(F.col("n_chars") > 500, F.col("n_chars") / 10.0).alias("readability_score"))
    nested = docs(spark, d).select("doc_id", F.struct(F.col("lang").alias("language"), F.col("n_chars").alias("char_count"), metrics.alias("quality_metrics")).alias("metadata"))
    return sh.flatten(nested)


@query("SELECT right(left(a, 100000), 1) IS NOT NULL AND len(list_filter(range(1, 81), lambda n: n <= length(a) AND n <= length(b) AND right(a, n) = left(b, n))) > 0 AS has_overlap FROM (SELECT (SELECT text FROM documents ORDER BY doc_id LIMIT 1) AS a, (SELECT text FROM documents ORDER BY doc_id LIMIT 1 OFFSET 1) AS b)")
def quick_overlap(spark, d):
    return pr.quick_overlap(docs(spark, d), "doc_id")


@query("WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS t FROM documents) SELECT doc_id FROM n WHERE i < 5 OR i BETWEEN t // 2 - 2 AND t // 2 + 2 OR (i >= t - 6 AND i < t - 1)")
def sampled_pairs(spark, d):
    return pr.sampled_pairs(docs(spark, d).select("doc_id"), "doc_id").select("doc_id")


@query(f"""WITH n AS (SELECT text AS a, lead(text) OVER (ORDER BY doc_id) AS b, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS t FROM documents),
p AS (SELECT a, b FROM n WHERE (i < 5 OR i BETWEEN t // 2 - 2 AND t // 2 + 2 OR i >= t - 6) AND i < t - 1 AND a <> '' AND b <> ''),
k AS (SELECT a, coalesce(list_max(list_filter(range(20, 201), lambda n: n <= least(length(a), length(b)) AND right(a, n) = left(b, n))), 0) AS k FROM p)
SELECT count(*) FILTER (k > 0) > 0 AS has_overlap, count(*) AS total_compared, count(*) FILTER (k > 0) AS overlapping_pairs, count(*) FILTER (k > 0) / count(*) AS overlap_rate,
  avg(k) FILTER (k > 0) AS avg_overlap_chars, avg(len({s_words('right(a, k)')})) FILTER (k > 0) AS avg_overlap_words FROM k""")
def overlap_summary(spark, d):
    return pr.overlap_summary(docs(spark, d).select("doc_id", "text"), "doc_id")


@query("SELECT 'documents' AS stage, count(*) AS n, round(avg(length(text)), 6) AS mean_chars FROM documents UNION ALL SELECT 'benchmark', count(*), round(avg(length(text)), 6) FROM benchmark")
def stage_counts(spark, d):
    return pr.stage_counts({"documents": docs(spark, d), "benchmark": table(spark, d, "benchmark")}).withColumn("mean_chars", F.round("mean_chars", 6))


@query("SELECT '/in/' || page_id || '.' || s AS source_path, CASE s WHEN 'txt' THEN 'text' WHEN 'HTM' THEN 'html' ELSE 'unknown' END AS file_type, s <> 'bin' AS success, CASE WHEN s = 'txt' THEN md5(html) END AS text_digest FROM (SELECT page_id, html, CASE page_id % 3 WHEN 0 THEN 'HTM' WHEN 1 THEN 'txt' ELSE 'bin' END AS s FROM pages)")
def extract_files(spark, d):
    suffix = F.when(F.col("page_id") % 3 == 0, "HTM").when(F.col("page_id") % 3 == 1, "txt").otherwise("bin")
    files = table(spark, d, "pages").select(F.concat(F.lit("/in/"), "page_id", F.lit("."), suffix).alias("path"), F.encode("html", "UTF-8").alias("content"))
    return ex.extract_files(files).select("source_path", "file_type", "success", F.when(F.col("file_type") == "text", F.md5("text")).alias("text_digest"))


@query()
def html_text(spark, d):
    return table(spark, d, "pages").select("page_id", "url", ex.html_text(F.col("html")).alias("text"))


@query()
def html_main_text(spark, d):
    return table(spark, d, "pages").select("page_id", "url", ex.html_main_text(F.col("html")).alias("text"))


@query()
def detect_language(spark, d):
    return docs(spark, d).select("doc_id", "lang", la.detect_language(F.col("text")).alias("detected"))


@query()
def readability(spark, d):
    return docs(spark, d).select("doc_id", F.round(la.readability(F.col("text")), 6).alias("readability_score"))


@query()
def fix_encoding(spark, d):
    return docs(spark, d).select("doc_id", la.fix_encoding(F.col("text")).alias("text"))


@query()
def preparation_report(spark, d):
    config = pl.PipelineConfig(chunk=ch.ChunkConfig("sentence", 50, 200, 20), quality=qu.QualityConfig.strict())
    return pl.removal_report(pl.prepare(docs(spark, d), config))
