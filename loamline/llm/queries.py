"""The registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, licences, minhash, mixing, mpeg, ranking, rules, sharding, toxicity, viterbi
from .common import crc_of_id, read


#: Folder of the public tokenizers' files, the same on every executor.
TOKENIZERS = os.environ.get("LOAMLINE_TOKENIZERS") or os.path.dirname(public_tokenizers.path("byte_bpe_50k.json"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted: Bradley-Terry quality of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_of_id(F.col("doc_id")) % 3 == 1
    model = ranking.train(docs, read(spark, sf_dir, "labels"), ~held_out)
    return ranking.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_mpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's padded bytes stored as MPEG audio and read back: digests, sizes and the stream's features."""
    stored = mpeg.store_media(read(spark, sf_dir, "documents"), keep=["doc_id"])
    back = mpeg.inspect_media(stored)
    payload = F.col("audio.payload")
    return back.select(
        "doc_id",
        F.col("audio.text_bytes").alias("n_bytes"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, -64, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(
            ";", F.array_join("audio.tags", "+"), "audio.vbr", F.concat(F.lit("frames="), "audio.frames"), F.concat(F.lit("samples="), "audio.duration_samples", F.lit("/"), "audio.rate"),
            F.concat(F.lit("kbps="), F.round("audio.kbps", 3)), F.concat(F.lit("crc="), "audio.crc_good", F.lit("+"), "audio.crc_bad"), F.concat(F.lit("resyncs="), "audio.resyncs"),
            F.concat(F.lit("offsets="), F.crc32(F.array_join("audio.frame_offsets", ",").cast("binary"))),
        ).alias("feature"),
        F.col("audio.duration").alias("duration"),
        F.col("audio.crc_bad").alias("crc_bad"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted: toxicity of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_of_id(F.col("doc_id")) % 4 == 2
    lexicon, forest = toxicity.train(docs, read(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, lexicon, forest).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, template, matched_words, template_words, coverage, start, end, partial of every licence found in a document."""
    return licences.scan_licences(read(spark, sf_dir, "documents"), keep=["doc_id"])


MIX_SHARE = 0.5


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, kept: token weights raked under the caps to the marginals, then sampled."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mix(docs, MIX_SHARE, capped=True).select("doc_id", "source", "lang", "topic", "tokens", F.round("probability", 6).alias("probability"), "kept")


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard by rendezvous hashing of doc_id over 8 (and 9) shards."""
    out = sharding.assign_shards(read(spark, sf_dir, "documents"), weights=(1.0,) * 8, grown=(1.0,) * 9)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the measurements, base_failed and kept under policy v1, with the ledger's bits in `failed`."""
    led = rules.ledger(read(spark, sf_dir, "documents"), keep=["doc_id"])
    base = rules.POLICIES["base"]
    return rules.apply_policy(led, "v1").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(base).cast("long")) != 0).alias("base_failed"), "kept", "failed",
    )


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rule, bit, n_failed, n_only_this, n_failed_with_any, n_rows: what each rule does within policy v2, from the ledger's bits."""
    return rules.ablations(rules.ledger(read(spark, sf_dir, "documents"), keep=["doc_id"]), "v2", rules.RULES)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, score: the unigram token count of every document."""
    return viterbi.count_tokens(read(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model", keep=["doc_id"])


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: near-duplicate classes on 2-word shingles at 0.8."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), minhash.Settings(shingle=2, percent=80))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document under the byte-level BPE vocabulary."""
    path = f"{TOKENIZERS}/byte_bpe_50k.json"
    return bpe.digests(bpe.encode(read(spark, sf_dir, "documents"), path, keep=["doc_id"], decoded="decoded"))


QUERIES = {
    f.__name__: f
    for f in (op1_quality, op2_mpeg, op3_toxicity, op4_licences, op5_mixing, op6_shards, op7_rules, op8_token_counts, op9_near_duplicates, op10_bpe, rule_ablations)
}

RULES_SQL = r"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT r, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS tri FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) t(k) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines, length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS n_upper,
  len(list_filter(w, lambda x: NOT regexp_matches(x, '[\pL\pN]'))) AS n_bare FROM d LEFT JOIN rep ON d.r = rep.r),
f AS (SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (4 * n_symbols > n_words)::BIGINT + 8 * (2 * n_upper > word_chars)::BIGINT
  + 16 * (2 * n_dup_lines > n_lines)::BIGINT + 32 * (10 * n_bare > 3 * n_words)::BIGINT + 64 * (word_chars > 30 * n_words OR word_chars < 2 * n_words)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed & 15 = 0 AS kept, failed FROM f"""

ABLATIONS_SQL = f"""WITH l AS ({RULES_SQL}), r(rule, bit) AS (VALUES {", ".join(f"('{r.name}', {r.bit})" for r in rules.RULES)})
SELECT rule, bit, count(*) FILTER (failed & (1 << bit) <> 0) AS n_failed, count(*) FILTER (failed = 1 << bit) AS n_only_this, count(*) FILTER (failed <> 0) AS n_failed_with_any, count(*) AS n_rows
FROM (SELECT failed & {rules.POLICIES["v2"]} AS failed FROM l), r GROUP BY rule, bit"""

#: All pairs of nearly equal size, compared on whole sets; the components by a closure.
NEAR_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, len(list_intersect(a.s, b.s)) AS n, len(a.s) + len(b.s) AS m FROM s a JOIN s b ON a.doc_id < b.doc_id AND len(a.s) > 0 AND 100 * len(a.s) >= 80 * len(b.s) AND 100 * len(b.s) >= 80 * len(a.s)),
e AS (SELECT a, b FROM c WHERE 100 * n >= 80 * (m - n) UNION ALL SELECT b, a FROM c WHERE 100 * n >= 80 * (m - n)),
reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
least AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(root, s.doc_id) AS component_id, s.doc_id = coalesce(root, s.doc_id) AS kept FROM s LEFT JOIN least ON s.doc_id = least.a"""

ORACLES: dict[str, str] = {"op5_mixing": mixing.oracle_capped(MIX_SHARE, mixing.TARGETS), "op7_rules": RULES_SQL, "rule_ablations": ABLATIONS_SQL, "op9_near_duplicates": NEAR_SQL}
